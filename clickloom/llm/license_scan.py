"""License scan by ordered signature rules.

A text becomes its lower-case words parted by one space. Rules are regular expressions over that; each is gated by words of which
all must occur, so most rules never see most texts. Detections are intervals of words. A detection goes if its interval lies within
that of another of higher priority, or of the same priority if that is longer, or as long and of an earlier rule. Places of the four base phrases
come from rules too, the first of all, and always stay."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame

from clickloom.llm.common import add_columns
from clickloom.llm.license_rules import RULES

#: Phrases whose places all count, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Kind of rule -> priority, and how sure a detection is.
KINDS = {"b": (4, 0.9), "t": (3, 0.95), "v": (2, 0.9), "n": (1, 0.7), "h": (0, 0.3)}

_WORD_BYTES = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_TO_WORDS = bytes(x if x in _WORD_BYTES else 0x20 for x in range(256)).lower()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def _version(match: re.Match) -> str:
    number = match[1] if " " in match[1] else f"{match[1]}(?: 0)?"
    return rf"(?:(?:version|ver|v) ?)?{number}"


class Rule:
    """Label, kind, alternatives of gate words and pattern; ``order`` is the place among all rules."""

    def __init__(self, order: int, label: str, kind: str, gates: str, pattern: str) -> None:
        self.order, self.label = order, label
        self.base = kind == "b"
        self.priority, self.sure = KINDS[kind]
        self.gates = [frozenset(x.encode().split(b"+")) for x in gates.split("|")]
        pattern = re.sub(r"<(\d+(?: \d+)?)>", _version, pattern).replace("<L>", "licen[cs]e")
        # A look-ahead finds overlapping places as well; white space is nothing but the one space.
        self.pattern = re.compile(rf"(?<![^ ])(?=((?:{pattern})(?![^ ])))".encode())


@lru_cache(1)
def rules() -> list[Rule]:
    base = [("b", label, phrase.replace(" ", "+"), phrase) for phrase, label in BASE.items()]
    own = [line.split("; ", 3) for line in RULES.splitlines()]
    lines = [(label, kind, gate, phrase) for kind, label, gate, phrase in base] + [tuple(x) for x in own]
    return [Rule(order, *line) for order, line in enumerate(lines)]


@lru_cache(1)
def _gates() -> dict[bytes, list[tuple[frozenset[bytes], Rule]]]:
    """One word of each gate, the longest, leads to the gate and its rule."""
    out = defaultdict(list)
    for rule in rules():
        for gate in rule.gates:
            out[max(gate, key=lambda w: (len(w), w))].append((gate, rule))
    return dict(out)


def detections(words: list[bytes]) -> list[tuple[int, int, Rule]]:
    """All matches (first word, word after the last, rule) of rules whose gate is open."""
    gates = _gates()
    if not (known := gates.keys() & set(words)):
        return []
    present = set(words)
    chosen = {rule.order: rule for word in known for gate, rule in gates[word] if gate <= present}
    text = b" ".join(words)
    found = sorted((m.start(1), m.end(1), order) for order, rule in chosen.items() for m in rule.pattern.finditer(text))
    out, at, before = [], 0, 0
    for begin, end, order in found:
        before += text.count(b" ", at, begin)
        at = begin
        out.append((before, before + text.count(b" ", begin, end) + 1, chosen[order]))
    return out


def unsuppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that no other suppresses, in the order of their places.

    Detections are taken by falling priority and length. Those that stay are kept with, for each begin, the furthest end, so that
    one search tells whether an interval lies within an earlier one."""
    from bisect import bisect_left, bisect_right, insort

    stay, begins, ends = [], [], []  # intervals that no other holds: begins and ends both rise
    for begin, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[2].order, x[0])):
        k = bisect_right(begins, begin)
        held = k > 0 and ends[k - 1] >= end
        # A base place holds no longer name: it stands for a family, so it takes no part in holding others.
        if rule.base:
            stay.append((begin, end, rule))
            continue
        if held:
            continue
        stay.append((begin, end, rule))
        low, high = bisect_left(begins, begin), bisect_right(ends, end)
        if low < high:
            del begins[low:high], ends[low:high]
        insort(begins, begin)
        insort(ends, end)
    return sorted(stay, key=lambda x: (x[0], x[1], x[2].order))


def scan(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, detections of a text."""
    words = words_of(text)
    stay = unsuppressed(detections(words))
    base = [begin for begin, _, rule in stay if rule.base]
    sure: dict[str, float] = {}
    for _, _, rule in stay:
        sure[rule.label] = max(sure.get(rule.label, 0.0), rule.sure)
    doubt = 1.0
    for label in sorted(sure):
        doubt *= 1 - sure[label]
    return (
        len(words), len(base), base[0] if base else None, base[-1] if base else None,
        ",".join(sorted({rule.label for _, _, rule in stay if rule.base})), ",".join(sorted(sure)), 1 - doubt,
        [{"label": rule.label, "first": begin, "last": end - 1} for begin, end, rule in stay],
    )


ADDED = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "detections array<struct<label: string, first: bigint, last: bigint>>"
)


def license_scan(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, ...) with words counted, places of the base phrases (number, smallest and largest first word),
    their labels, all labels (sorted, joined by commas), a score and the detections (label, first and last word) added.

    The score is the probability that at least one label is right, taking labels as independent; 0 without one. Null and
    empty texts have no words, places or labels. Repeated rows get the same result. Columns of the input with one of the
    added names are replaced."""
    return add_columns(docs, ADDED, lambda: lambda texts: [list(column) for column in zip(*map(scan, texts), strict=True)] or [[] for _ in range(8)])
