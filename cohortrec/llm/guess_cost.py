"""Guess cost of a password-like value: the cheapest segmentation, in powers of ten.

Dynamic programming over positions. A value is cut into dictionary words (with capitals and
letter-like digits), dates, repeats, walks along keyboard or alphabet rows, and brute-force
characters; each segment costs the logarithm of the guesses it takes, and the costs add up. Every
position has a bounded number of segments, so cost is linear in the length and no value is cut short. Beside the costs so
far nothing is kept, so a value of megabytes takes no more than its own size in numbers.

Web addresses and file paths are no secrets as such: one made of ordinary parts costs about as much as its
most unusual part. Words are ranked by a table; without one a short list of common passwords serves.
"""

import re
from array import array
from collections import defaultdict
from collections.abc import Sequence
from math import log10

# Common passwords and words in them, most frequent first.
WORDS = (
    "password the admin login welcome letmein secret master dragon monkey shadow sunshine princess "
    "football baseball superman batman trustno test guest root user default change changeme example "
    "demo temp temporary hello world love iloveyou summer winter spring autumn january february "
    "march april may june july august september october november december monday tuesday "
    "wednesday thursday friday saturday sunday pass word your here key token api my new old this that "
    "and for you with company server database account email name value string none null true "
    "false todo placeholder redacted dummy sample fake foo bar baz xxx abc qwerty access private "
    "public system manager service production development staging local host home computer internet "
    "google michael jordan jennifer michelle daniel andrew joshua ashley thomas robert charlie maggie "
    "ginger pepper cookie summer flower orange purple yellow silver golden black white green blue red "
    "freedom killer soccer hockey ranger hunter tigger buster cheese coffee money lucky angel star"
).split()
LEET = str.maketrans("430157@$!", "aeoistasi")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
DATES = tuple(
    re.compile(p)
    for p in (
        r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])",
        r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d",
        r"(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])[-/._]?(?:19|20)\d\d",
    )
)
YEAR = re.compile(r"(?:19|20)\d\d")
DATE_COST, YEAR_COST = log10(365 * 120 * 4), log10(120)
PATTERNS = [(p, DATE_COST) for p in DATES] + [(YEAR, YEAR_COST)]
# Longest part inside a longer stretch, and the longest repeated block.
PART, BLOCK = 24, 8
SEGMENT_COST = log10(2)  # that another segment begins


def _neighbours() -> dict[tuple[str, str], str]:
    """The direction between keys beside each other in a row, or above each other on the keyboard."""
    found = {}
    for row in ROWS:
        for a, b in zip(row, row[1:]):
            found |= {(a, b): "right", (b, a): "left"}
    for upper, lower in zip(ROWS[:3], ROWS[1:4]):
        for i, a in enumerate(upper):
            for b in lower[max(i - 1, 0) : i + 1]:
                found |= {(a, b): "down", (b, a): "up"}
    return found


NEXT_TO = _neighbours()


def _brute(char: str) -> float:
    if char.isdigit():
        return log10(10)
    if char.isascii() and char.isalpha():
        return log10(26)
    return log10(33) if char.isascii() else log10(100)


class WordTable:
    """Words of three letters or more in lower case, by rank from 1, and all their endings to look words up by."""

    def __init__(self, words: Sequence[str]):
        self.rank = {word: rank for rank, word in reversed(list(enumerate(words, 1)))}
        self.endings = {word[i:] for word in self.rank for i in range(len(word) - 2)}

    def ending_at(self, text: str, end: int):
        """``(begin, rank)`` of the words that end at ``end``."""
        for begin in range(end - 3, -1, -1):
            word = text[begin:end]
            if word not in self.endings:
                return
            if rank := self.rank.get(word):
                yield begin, rank


COMMON = WordTable(WORDS)
# Fixed patterns: how a web address or path begins, and what separates its parts.
LOCATOR = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*://|~?/|\.{1,2}/|[A-Za-z]:\\|www\.)[^\s]+\Z")
PART_BORDER = re.compile(r"[/\\.:_?=&#%+~-]+")
LOCATOR_COST = 2.0


def log10_guesses(value: str, table: WordTable = COMMON) -> float:
    """0 for an empty value."""
    cost = _segmented(value, table)
    if LOCATOR.match(value):
        parts = [p for p in PART_BORDER.split(value) if p]
        most = max((_segmented(p, table) for p in parts), default=0.0)
        cost = min(cost, LOCATOR_COST + log10(len(parts) + 1) + most)
    return cost


def _capitals(part: str, lower: str) -> float:
    return 0.0 if part == lower else log10(2) if part[1:] == lower[1:] else log10(8)


def _segmented(value: str, table: WordTable) -> float:
    n, lower = len(value), value.lower()
    if len(lower) != n:  # a character whose lower case is longer
        lower = value
    plain = lower.translate(LEET)
    leet = plain != lower
    cost_of = {c: _brute(c) for c in set(value)}
    brute = array("d", [0.0])
    for c in value:
        brute.append(brute[-1] + cost_of[c])
    best = array("d", [0.0])
    dates: dict[int, list[tuple[int, float]]] = defaultdict(list)  # by end, for ends not reached yet
    same = walk = 0  # where the stretch of equal, or of neighbouring, characters begins that the last one is in
    turns = array("l", [0])  # changes of direction up to each character
    step: str | None = None
    repeat = [0] * (BLOCK + 1)  # by period: from where on each character equals the one a period before

    for end in range(1, n + 1):
        last = end - 1
        char = value[last]
        if char.isdigit():
            for pattern, cost in PATTERNS:
                if m := pattern.match(value, last):
                    dates[m.end()].append((last, cost))
        least = best[last] + cost_of[char]

        def try_part(begin: int, cost: float) -> None:
            nonlocal least
            least = min(least, best[begin] + cost + SEGMENT_COST)

        for begin, rank in table.ending_at(lower, end):
            try_part(begin, log10(rank + 1) + _capitals(value[begin:end], lower[begin:end]))
        if leet:
            for begin, rank in table.ending_at(plain, end):
                if plain[begin:end] != lower[begin:end]:
                    try_part(begin, log10(rank + 1) + _capitals(value[begin:end], lower[begin:end]) + log10(4))
        for begin, cost in dates.pop(end, ()):
            try_part(begin, cost)
        if last and value[last - 1] != char:
            same = last
        for begin in _begins(same, end, 3, 1, end == n or value[end] != char):
            try_part(begin, cost_of[char] + log10(end - begin))
        if last:
            direction = NEXT_TO.get((lower[last - 1], lower[last]))
            turns.append(turns[-1] + (direction != step))
            step = direction
            if direction is None:
                walk = last
            stops = end == n or (lower[last], lower[end]) not in NEXT_TO
            for begin in _begins(walk, end, 3, 1, stops):
                try_part(begin, log10(47) + (turns[last] - turns[begin + 1]) * log10(3) + log10(end - begin))
        for period in range(2, BLOCK + 1):
            if last < period or value[last - period] != char:
                repeat[period] = end
            elif end - repeat[period] >= period and repeat[period] - period < same:  # else one character repeats
                stops = end == n or value[end - period] != value[end]
                for begin in _begins(repeat[period] - period, end, 2 * period, period, stops):
                    try_part(begin, brute[begin + period] - brute[begin] + log10((end - begin) // period))
        best.append(least)
    return best[n]


def _begins(begin: int, end: int, least: int, step: int, stops: bool):
    """Begins of the parts of a stretch that end here: those of up to ``PART`` characters, and the stretch's own
    begin; where the stretch stops, all."""
    if end - begin < least:
        return
    nearest = end - least
    yield from range(nearest, max(begin, 0 if stops else end - PART) - 1, -step)
    if not stops and end - begin > PART and (end - begin) % step == 0:
        yield begin
