"""Pieces and merge order of a SentencePiece BPE model, read through the public library."""

import numpy as np

SPACE = "▁"
NONE = np.int32(2**31 - 1)  # the rank of a pair that makes no piece


class PieceModel:
    """``rank`` orders merges: pieces with a higher score merge earlier, equal scores share a rank.

    ``left`` and ``right`` are the two pieces that a piece is merged from last when it is encoded by itself;
    single characters have rank -1. ``reachable`` pieces are those that merging can make.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.encode("a b", out_type=str)[0][:1] != SPACE or sp.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("only models with an identity normalizer and a leading space are supported")
        self.size = sp.vocab_size()
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        skipped = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        # A space stands for the mark inside this package.
        self.text = {i: sp.id_to_piece(i).replace(SPACE, " ") for i in range(self.size) if not skipped(i)}
        self.ids = {t: i for i, t in self.text.items()}
        self.chars = sorted({c for t in self.text.values() for c in t})
        if any(" " in t.lstrip(" ") for t in self.text.values()):
            raise ValueError("a piece crosses a word border")
        if missing := [c for c in self.chars if c not in self.ids]:
            raise ValueError(f"characters without a piece of their own: {missing[:5]}")
        score = {i: sp.get_score(i) for i in self.text}
        # Scores of BPE models number the merges; other kinds hold logarithms of probabilities.
        if any(value != int(value) for value in score.values()):
            raise ValueError("only BPE models are supported")
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.merge_rank = {i: order[s] for i, s in score.items()}
        self.rank = np.full(self.size, -1, dtype=np.int32)
        self.left = np.arange(self.size, dtype=np.int32)
        self.right = np.arange(self.size, dtype=np.int32)
        self.reachable = np.zeros(self.size, dtype=bool)
        pairs = {}
        for i, text in self.text.items():
            for cut in range(1, len(text)):
                a, b = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = self.merge_rank[i]
            last = self._last_merge(text)
            if last is not None:
                self.reachable[i] = True
                if len(text) > 1:
                    self.rank[i] = self.merge_rank[i]
                    self.left[i], self.right[i] = last
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int32)
        # What each id stands for in decoded text.
        self.spelled = [b""] * self.size
        for i, text in self.text.items():
            self.spelled[i] = text.encode()
        for byte, i in enumerate(self.byte_ids):
            self.spelled[i] = bytes([byte])
        self.spelled[sp.unk_id()] = " ⁇ ".encode()

    def _last_merge(self, text: str) -> tuple[int, int] | None:
        """The two pieces merged last, if merging ``text`` by itself ends in one piece."""
        parts, last = list(text), (0, 0)
        while len(parts) > 1:
            ways = [(self.merge_rank[i], k) for k in range(len(parts) - 1) if (i := self.ids.get(parts[k] + parts[k + 1])) is not None]
            if not ways:
                return None
            _, k = min(ways)
            last = self.ids[parts[k]], self.ids[parts[k + 1]]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return last

    def stays_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of ``a`` and ``b`` (reachable pieces) ends in just these two.

        Merges are undone from the last one on. At each state the pair at the border must not make a piece
        that would have merged before: earlier than the last merge of the left piece, or not later
        than that of the right piece, since of equal ranks the left place goes first.
        """
        apart = np.zeros(len(a), dtype=bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int32), b.astype(np.int32)
        limit = np.full(len(a), NONE, dtype=np.int32)
        while len(at):
            key = a.astype(np.int64) * self.size + b
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            fits = ~((self.pair_keys[place] == key) & (self.pair_ranks[place] < limit))
            done = fits & (self.rank[a] < 0) & (self.rank[b] < 0)
            apart[at[done]] = True
            on = fits & ~done
            at, a, b = at[on], a[on], b[on]
            undo_left = self.rank[a] > self.rank[b]
            limit = np.where(undo_left, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return apart
