"""Licence scan: an Aho-Corasick automaton over words, and a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litwire.llm.common import as_bytes

# Phrases, their labels, and how free each label leaves the user.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
NOTICE_PHRASES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "eclipse public license": "epl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
FREEDOM = {
    "public-domain": 1.0,
    "cc0": 1.0,
    "mit": 0.9,
    "isc": 0.9,
    "bsd": 0.9,
    "apache": 0.9,
    "cc-by": 0.8,
    "mpl": 0.6,
    "epl": 0.6,
    "lgpl": 0.6,
    "cc-by-sa": 0.5,
    "gpl": 0.4,
    "agpl": 0.3,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.2,
    "reserved": 0.1,
}
EXCEPTION = 0.1
UNLISTED = 0.5

#: ASCII letters lower-cased, other ASCII but digits a blank, all else as it is.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
EXPRESSION = re.compile(rb"spdx-license-identifier:[\x20\t]*([^\r\n\"']*)", re.I)
TOKEN = re.compile(r"[()]|[^\s()]+")
PRECEDENCE = {"with": 3, "and": 2, "or": 1}
GAP = 3


class Automaton:
    """Finds phrases of words in one pass (Aho-Corasick); places are (first word, phrase)."""

    def __init__(self, phrases: list[str]):
        self.step: list[dict[str, int]] = [{}]
        self.fail: list[int] = [0]
        self.ends: list[list[tuple[int, str]]] = [[]]
        for phrase in phrases:
            state, words = 0, phrase.split()
            for word in words:
                if word not in self.step[state]:
                    self.step[state][word] = len(self.step)
                    self.step.append({})
                    self.fail.append(0)
                    self.ends.append([])
                state = self.step[state][word]
            self.ends[state].append((len(words), phrase))
        waiting = deque(self.step[0].values())
        while waiting:
            state = waiting.popleft()
            for word, after in self.step[state].items():
                waiting.append(after)
                back = self.fail[state]
                while back and word not in self.step[back]:
                    back = self.fail[back]
                found = self.step[back].get(word, 0)
                self.fail[after] = found if found != after else 0
                self.ends[after] += self.ends[self.fail[after]]

    def places(self, words: list[str]) -> list[tuple[int, int, str]]:
        """(first word, word after the last, phrase) of all places, overlapping ones too."""
        step, fail, ends, found, state = self.step, self.fail, self.ends, [], 0
        for at, word in enumerate(words):
            while state and word not in step[state]:
                state = fail[state]
            state = step[state].get(word, 0)
            if state and ends[state]:
                found += [(at + 1 - length, at + 1, phrase) for length, phrase in ends[state]]
        return found


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands and operators in postfix order; stray brackets and operators are left out."""
    out, held, operand = [], [], False
    for token in tokens:
        kind = token.lower()
        if kind == "(":
            if not operand:
                held.append(kind)
        elif kind == ")":
            if operand and "(" in held:
                while held[-1] != "(":
                    out.append(held.pop())
                held.pop()
        elif kind in PRECEDENCE:
            if operand:
                while held and PRECEDENCE.get(held[-1], 0) >= PRECEDENCE[kind]:
                    out.append(held.pop())
                held.append(kind)
                operand = False
        elif operand:
            break  # two names side by side: the expression ended before
        else:
            out.append(kind)
            operand = True
    while held and not operand:  # an operator without a right side
        if held.pop() in PRECEDENCE:
            operand = True
    return out + [op for op in reversed(held) if op != "("]


def name_freedom(name: str) -> float:
    """Of a licence name: by the listed label that it is, or begins with."""
    name = name.rstrip("+")
    best = max((label for label in FREEDOM if name == label or name.startswith(label + "-")), key=len, default="")
    return FREEDOM.get(best, UNLISTED)


def evaluate(rpn: list[str]) -> float:
    """How free an expression leaves its user: or takes the better, and the worse, with adds an exception."""
    stack: list[float | str] = []
    for token in rpn:
        if token not in PRECEDENCE:
            stack.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        value = name_freedom(left) if isinstance(left, str) else left
        if token == "with":
            stack.append(min(1.0, value + EXCEPTION))
            continue
        other = name_freedom(right) if isinstance(right, str) else right
        stack.append(max(value, other) if token == "or" else min(value, other))
    return min((name_freedom(v) if isinstance(v, str) else v for v in stack), default=0.0)


def names_of(rpn: list[str]) -> set[str]:
    """Licence names of an expression; what stands after ``with`` is an exception, not a licence."""
    stack: list[set[str]] = []
    for token in rpn:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else left | right)
        else:
            stack.append({token.replace(",", "")})
    return set().union(*stack)


def statements(places: list[tuple[int, int, str]], words: list[str], label: dict[str, str]) -> list[list[str]]:
    """Token lists from notices: two that stand within GAP words, one of them and/or/with, are one expression."""
    longest: list[tuple[int, int, str]] = []
    for place in sorted(places, key=lambda p: (p[0], -p[1])):
        if place[2] in label and (not longest or place[0] >= longest[-1][1]):
            longest.append(place)
    lists: list[list[str]] = []
    after = None
    for first, end, phrase in longest:
        between = words[after:first] if after is not None and first - after <= GAP else []
        link = next((w for w in between if w in PRECEDENCE), None)
        if link:
            lists[-1] += [link, label[phrase]]
        else:
            lists.append([label[phrase]])
        after = end
    return lists


LABELS = BASE_PHRASES | NOTICE_PHRASES


def scan_text(text: bytes | None, automaton: Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    text = text or b""
    words = text.translate(WORD_BYTES).decode("utf-8", "replace").split(" ")
    words = [w for w in words if w]
    places = automaton.places(words)
    base = [p for p in places if p[2] in BASE_PHRASES]
    starts = [p[0] for p in base]
    base_labels = {BASE_PHRASES[p[2]] for p in base}
    labels, values = set(base_labels), []
    if places:
        for tokens in statements(places, words, LABELS):
            rpn = postfix(tokens)
            labels |= names_of(rpn)
            values.append(evaluate(rpn))
        if any(p[2] == TAG for p in places):
            for match in EXPRESSION.finditer(text):
                rpn = postfix(TOKEN.findall(match[1].decode("utf-8", "replace")))
                if rpn:
                    labels |= names_of(rpn)
                    values.append(evaluate(rpn))
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(base), *ends, ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(values, default=0.0)


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, RESULT.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters
    beyond ASCII. ``labels`` holds labels of base phrases, of further notices
    and the names in SPDX expressions; ``score`` tells how free the most
    restrictive statement leaves the user (0 if nothing was found). Missing
    and empty texts have no words. Repeated rows get equal results; other
    columns are left aside; an empty table gives an empty table.
    """

    def run(batches):
        automaton = Automaton([*LABELS, TAG])
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            rows = [scan_text(t, automaton) for t in as_bytes(batch.column(1))]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *[c.split()[0] for c in RESULT.split(", ")]])

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return taken.mapInArrow(run, f"doc_id long, {RESULT}")
