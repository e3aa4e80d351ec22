"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its structural elements, told apart by their path, and its text blocks. Over all
pages of a host, tokens with one occurrence vector (how often each page holds them) form an
equivalence class. Pages with one body are copies and count once. Vectors are as long as the host has pages, so they are
compared by a mergeable 64-bit digest: Spark combines one partial row per token and task, and a host with a third of all
pages is as cheap as any other.

A class is valid where its tokens keep one order on all pages. A second look at the pages ranks the tokens of a class
inside the element that holds them; a token whose rank wanders more than others can explain comes from the data and
leaves the class. What is left of the classes nests into the host's template. Its elements are the slots. Text is template text
only as a member of a class of enough tokens: text that most pages repeat, but not in step with the template, is data.
Only the template, bounded by the mean page length, meets in one group. A page's blocks then fall into
slots, and the article's slots remain.
"""

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortrec.llm.html_blocks import BOILER, HEADING, MAIN, Block, parse
from cohortrec.llm.tokens import byte_slices, release_memory
from cohortrec.plans.materialize import materialize

SUPPORT = 0.5  # share of a host's distinct pages that a template token is on
REPEATED = 3  # distinct pages that a block of template text is on at least; fewer do not tell template from data
ENOUGH = 3  # tokens of a class with template text; an element is two, as it begins and ends
MAIN_SHARE = 0.05  # share of a page's article text below which main elements are teasers
LINKED = 0.5  # share of linked characters from which a slot is a menu
TOKENS = "host string, path long, text long, body long, parent long, flags int, vector long, place double, chars long, linked long"
NO_TEXT = ROOT = 0
KNOWN_HOSTS = 1000  # templates a task holds at once, without effect on results


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, otherwise empty."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def text_digest(text: str) -> int:
    return (xxhash.xxh64_intdigest(text) >> 1) or 1


def text_key(block: Block) -> int:
    """What tells the text of a block from others: inside main elements with its path, elsewhere without it."""
    return text_digest(f"{block.path} {block.text}" if block.flags & MAIN else block.text)


def page_tokens(page: str) -> list[tuple]:
    """``(path, text, body, parent, flags, vector, place, chars, linked)`` of one page, once per token.

    ``body`` is the digest of the page's texts, without boilerplate where it has others. The root
    token with path 0 stands for the page itself.
    """
    blocks, elements = parse(page)
    chars: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    texts: dict[tuple[int, int], list[int]] = {}
    for block in blocks:
        chars[block.path] += len(block.text)
        linked[block.path] += min(block.link_chars, len(block.text))
        texts.setdefault((block.path, text_key(block)), [block.flags, 0])[1] += 1
    body = text_digest("\n".join(b.text for b in [b for b in blocks if not b.flags & BOILER] or blocks))
    vector = lambda count: xxhash.xxh64_intdigest(f"{body} {count}") >> 1
    rows = [(ROOT, NO_TEXT, body, ROOT, 0, 0, 0.0, 0, 0)]
    rows += [
        (path, NO_TEXT, body, parent, flags, vector(count), float(place), chars[path], linked[path])
        for path, (parent, flags, count, place) in elements.items()
    ]
    rows += [(path, text, body, path, flags, vector(count), 0.0, 0, 0) for (path, text), (flags, count) in texts.items()]
    return rows


def host_tokens(pages: DataFrame) -> DataFrame:
    """One row per (host, token), from pages with ``host`` and ``html``; ``pages`` counts distinct page bodies.

    Copies of a page, repeated rows among them, count once: rows of one body meet first, and as they
    differ in nothing that matters, the least of each value stands for them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in byte_slices(batch, "html"):
                found: dict[tuple, tuple] = {}
                for host, page in zip(*(rows[c].to_pylist() for c in ("host", "html"))):
                    for path, text, body, *values in page_tokens(page or ""):
                        key = (host, path, text, body)
                        known = found.get(key)
                        found[key] = tuple(values) if known is None else tuple(map(min, known, values))
                columns = list(zip(*[(*key, *row) for key, row in found.items()])) or [()] * 10
                types = [pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.float64(), *[pa.int64()] * 2]
                names = [f.split()[0] for f in TOKENS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    tokens = pages.select("host", "html").mapInArrow(run, TOKENS)
    values = ("parent", "flags", "vector", "place", "chars", "linked")
    tokens = tokens.groupBy("host", "path", "text", "body").agg(*[F.min(c).alias(c) for c in values])
    return tokens.groupBy("host", "path", "text").agg(
        F.min("parent").alias("parent"),
        F.min("flags").alias("flags"),
        F.count("*").alias("pages"),
        F.bit_xor("vector").alias("vector"),
        F.sum("place").alias("place"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
    )


def members_of(tokens: list[dict]) -> tuple[list[int], list[int], list[int]]:
    """Paths, texts and classes of a host's frequent tokens."""
    return tuple([t[name] for t in tokens] for name in ("path", "text", "vector"))


def class_ranks(page: str, members: dict[tuple[int, int], int]) -> Iterator[tuple[int, int, int]]:
    """``(path, text, rank)`` of the tokens of a page that are ``members`` (with their class) of their host's classes.

    Tokens of one class that stand in the same frequent element are ranked by their first place in it.
    """
    blocks, elements = parse(page)
    holder_of: dict[int, int] = {ROOT: ROOT}

    def holder(path: int) -> int:
        """The nearest frequent element at or above ``path``."""
        way = []
        while path not in holder_of and (path, NO_TEXT) not in members:
            way.append(path)
            path = elements[path][0]
        found = holder_of.get(path, path)
        for p in way:
            holder_of[p] = found
        return found

    groups: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
    for path, (parent, _, _, place) in elements.items():
        if (vector := members.get((path, NO_TEXT))) is not None:
            groups[vector, holder(parent)].append((place, path, NO_TEXT))
    seen = set()
    for block in blocks:
        key = (block.path, text_key(block))
        if key in members and key not in seen:
            seen.add(key)
            groups[members[key], holder(block.path)].append((block.place, *key))
    for group in groups.values():
        for rank, (_, path, text) in enumerate(sorted(group)):
            yield path, text, rank


def wandering(tokens: list[dict]) -> set[tuple[int, int]]:
    """``(path, text)`` of the tokens that keep no place in the order of their class.

    ``low`` and ``high`` are a token's least and greatest rank in its group of the class. One token that wanders shifts those it
    passes by one rank, so as many ranks are allowed as tokens were taken out, the farthest wanderers first.
    """
    element_of = {t["path"]: t for t in tokens if t["text"] == NO_TEXT}

    def holder(token: dict) -> int:
        path = token["parent"]
        return path if path in element_of else ROOT

    groups: dict[tuple[int, int], list[dict]] = defaultdict(list)
    for token in tokens:
        groups[token["vector"], holder(token)].append(token)
    gone: set[tuple[int, int]] = set()
    for group in groups.values():
        taken = 0
        ranked = sorted(group, key=lambda t: ((t.get("low") or 0) - (t.get("high") or 0), t["path"], t["text"]))
        for token in ranked:
            if (token.get("high") or 0) - (token.get("low") or 0) <= taken:
                break
            gone.add((token["path"], token["text"]))
            taken += 1
    return gone


def deduce(tokens: list[dict]) -> tuple[list[int], list[int], list[int]]:
    """Slots of one host's template, the ones among them with varying article text, and template text.

    ``tokens`` are the frequent tokens of the host; those of one vector are a class, less those that wander in its
    order. Classes are placed from the most frequent and largest on. An element nests when its parent is the page or an element
    placed before. A class of which only a part nests is split: that part is placed, and the others
    wait as a class of their own for what they stand in. Text is template text if it stands in a slot and its class has
    ``ENOUGH`` tokens. A slot of mostly linked text is a menu; inside main elements headings are none, and
    neither is what fewer than ``REPEATED`` pages show.
    """
    gone = wandering(tokens)
    regular = [t for t in tokens if (t["path"], t["text"]) not in gone]
    classes: dict[int, list[dict]] = defaultdict(list)
    size: dict[int, int] = defaultdict(int)
    for token in sorted(regular, key=lambda t: (t["place"] / t["pages"], t["path"])):
        size[token["vector"]] += 2 if token["text"] == NO_TEXT else 1
        if token["text"] == NO_TEXT:
            classes[token["vector"]].append(token)
    waiting = sorted(classes.values(), key=lambda c: (-c[0]["pages"], -len(c), c[0]["path"]))
    slots: dict[int, dict] = {}
    placed = True
    while placed and waiting:
        placed = False
        for at, members in enumerate(waiting):
            rest = []
            for token in members:  # in page order, so a parent comes before what it holds
                if token["parent"] == 0 or token["parent"] in slots:
                    slots[token["path"]] = token
                else:
                    rest.append(token)
            placed |= len(rest) < len(members)
            waiting[at] = rest
        waiting = [c for c in waiting if c]

    def menu(slot: dict) -> bool:
        if slot["flags"] & MAIN and (slot["flags"] & HEADING or slot["pages"] < REPEATED):
            return False
        return slot["linked"] >= LINKED * max(slot["chars"], 1)

    content = [p for p, t in slots.items() if not t["flags"] & BOILER and not menu(t)]
    fixed = [
        t["text"]
        for t in regular
        if t["text"] != NO_TEXT and t["path"] in slots and t["pages"] >= REPEATED and size[t["vector"]] >= ENOUGH
    ]
    return list(slots), content, fixed


def host_templates(pages: DataFrame) -> DataFrame:
    """``(host, slots, content, fixed)``, one row per host, as a written table."""
    tokens = host_tokens(pages)
    written = materialize(tokens.where(f"text = {NO_TEXT} OR pages >= {REPEATED}"), "tokens")
    counts = written.where(f"path = {ROOT}").select("host", F.col("pages").alias("host_pages"))
    frequent = written.where(f"path <> {ROOT}").join(counts, "host").where(F.col("pages") >= SUPPORT * F.col("host_pages"))
    frequent = materialize(frequent.drop("host_pages"), "frequent")
    longs = pa.list_(pa.int64())

    def one_row(find, names: list[str]):
        """A function of the tokens of one host that returns lists, as one row per host."""

        def run(table: pa.Table) -> pa.Table:
            columns = [table["host"].slice(0, 1).combine_chunks(), *(pa.array([v], longs) for v in find(table.to_pylist()))]
            return pa.table(columns, names=["host", *names])

        return run, "host string, " + ", ".join(f"{name} array<long>" for name in names)

    run, schema = one_row(members_of, ["paths", "texts", "classes"])
    members = materialize(frequent.groupBy("host").applyInArrow(run, schema), "members")
    ranks = page_ranks(pages, members).groupBy("host", "path", "text").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranked = frequent.join(materialize(ranks, "ranks"), ["host", "path", "text"], "left")
    run, schema = one_row(deduce, ["slots", "content", "fixed"])
    return materialize(ranked.groupBy("host").applyInArrow(run, schema), "templates")


def page_ranks(pages: DataFrame, members: DataFrame) -> DataFrame:
    """``(host, path, text, low, high)``: least and greatest rank of each token, combined inside a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict[tuple[int, int], int]] = {}
        for batch in batches:
            for part in byte_slices(batch, "html"):
                found: dict[tuple[str, int, int], list[int]] = {}
                for row, (host, page) in enumerate(zip(part["host"].to_pylist(), part["html"].to_pylist())):
                    if host not in known:
                        if len(known) > KNOWN_HOSTS:
                            known.clear()
                        paths, texts, classes = (part[c][row].as_py() or () for c in ("paths", "texts", "classes"))
                        known[host] = dict(zip(zip(paths, texts), classes))
                    for path, text, rank in class_ranks(page or "", known[host]):
                        ends = found.setdefault((host, path, text), [rank, rank])
                        ends[0], ends[1] = min(ends[0], rank), max(ends[1], rank)
                columns = list(zip(*[(*key, *ends) for key, ends in found.items()])) or [()] * 5
                arrays = [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays(arrays, ["host", "path", "text", "low", "high"])
        release_memory()

    # No hint: members are broadcast if the written table is small, otherwise pages are shuffled by host.
    joined = pages.select("host", "html").join(members, "host")
    return joined.select("host", "html", "paths", "texts", "classes").mapInArrow(run, "host string, path long, text long, low long, high long")


def article_blocks(page: str, slots: set[int], content: set[int], fixed: set[int]) -> list[Block]:
    """The blocks of a page that fall into the article's slots.

    A block belongs to the nearest slot of the template above it. Blocks below boilerplate elements go. Of what is
    left, the article is what stands in slots that are no menus and is not template text. Blocks outside of every slot
    count as article, and inside main elements also those whose nearest slot lies outside of them. If main
    elements hold at least ``MAIN_SHARE`` of this text, what stands outside of them goes; with less they are teasers.
    """
    blocks, elements = parse(page)
    slot_of: dict[int, int] = {0: 0}

    def slot(path: int) -> int:
        way = []
        while path not in slot_of:
            if path in slots:
                slot_of[path] = path
                break
            way.append(path)
            path = elements[path][0]
        for p in way:
            slot_of[p] = slot_of[path]
        return slot_of[path]

    def article(block: Block) -> bool:
        found = slot(block.path)
        own = not found or block.flags & MAIN and not elements[found][1] & MAIN
        return (own or found in content) and text_key(block) not in fixed

    found = [b for b in blocks if not b.flags & BOILER and article(b)]
    main = [b for b in found if b.flags & MAIN]
    chars = sum(len(b.text) for b in main)
    if any(b.flags & MAIN and not b.flags & BOILER for b in blocks) and chars >= MAIN_SHARE * sum(len(b.text) for b in found):
        return main
    return found


def extract_articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)``, one row per input row; ``text`` is empty if there is no article.

    Character references are decoded, white space inside a block becomes one space, blocks are
    joined by one space in page order. NULL html counts as empty. Pages without a host share one template.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    templates = host_templates(rows)
    # No hint: templates are broadcast if the written table is small, otherwise pages are shuffled by host.
    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "host", "slots", "content", "fixed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[set[int], ...]] = {}
        for batch in batches:
            for part in byte_slices(batch, "html"):
                texts = []
                for row, (host, page) in enumerate(zip(part["host"].to_pylist(), part["html"].to_pylist())):
                    if host not in known:
                        if len(known) > KNOWN_HOSTS:
                            known.clear()
                        known[host] = tuple(set(part[c][row].as_py() or ()) for c in ("slots", "content", "fixed"))
                    texts.append(" ".join(b.text for b in article_blocks(page or "", *known[host])))
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    kind = dict(rows.dtypes)["page_id"]
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
