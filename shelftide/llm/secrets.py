"""Secret scans: fixed rules, and formats learned from what the rules find.

The rules find credentials by keyword, prefix or alphabet. All different ones are the labelled set from which a probabilistic
automaton is inferred per rule: a prefix tree of the strings, whose states are merged while the frequencies of the ``AHEAD``
characters after them are statistically compatible (Hoeffding's bound at ``ALPHA``). Another automaton comes from all runs of
the same characters that no rule covers. The states are found level by level: tasks lead every string through the states known
so far and count what follows each, the driver sees the sums only and gives the states that are new a place. Incompatible states
that less than ``SHARE`` of the strings reach join the nearest one, so that the automaton does not grow with the table.

Every run of ``RUN`` characters or more that no rule covers, with a letter and a digit, is scored by the best log-likelihood of a
rule's format against that of ordinary runs, per character; those from ``THRESHOLD`` on are spans of kind ``format``. Spans of
the rules always stay.

Null and empty texts have no spans. Repeated rows are scanned alike; an empty table gives an empty result; without labelled
credentials there is no format to learn and nothing is added. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Rules in order, then the learned kind. Fixed values.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]+", r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

RUN = 16
ALPHA = 0.05
AHEAD = 2
SHARE = 0.001
THRESHOLD = 1.0

_SYMBOLS = "A-Za-z0-9+/_.=-"
_ALPHABET = 67
_SMOOTH = 0.5
#: Stands for the end of a string; runs hold no line feed.
_END = "\n"
_BOUND = math.sqrt(0.5 * math.log(2 / ALPHA))
_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access, _hex, _run = re.compile(ACCESS), re.compile(HEX), re.compile(f"[{_SYMBOLS}]{{{RUN},}}")

Span = tuple[int, int, int, str]


def base_spans(text: str, runs: list[tuple[int, str]] | None = None) -> list[Span]:
    """``(kind, start, end, credential)`` of the rules. Whatever a prefix or an alphabet finds lies inside a long run."""
    if runs is None:
        runs = [(m.start(), m[0]) for m in _run.finditer(text)]
    out = [(0, *m.span(), m[2]) for m in _assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, rule in ((1, _access), (2, _hex)):
        for at, run in runs:
            out += [(kind, at + m.start(), at + m.end(), m[0]) for m in rule.finditer(run) if m.end() - m.start() >= LEAST[KINDS[kind]]]
    return sorted(out)


def _candidates(base: list[Span], runs: list[tuple[int, str]]) -> list[Span]:
    """Long runs that no span of the rules touches."""
    return [(3, at, at + len(run), run) for at, run in runs if not any(s < at + len(run) and at < e for _, s, e, _ in base)]


_SPANS = "array<struct<kind:int,start:int,end:int,value:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)``: spans of the rules and, as kind 3, the runs that may be scored."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def of(text: str) -> list[Span]:
        runs = [(m.start(), m[0]) for m in _run.finditer(text)]
        base = base_spans(text, runs)
        return base + _candidates(base, runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            # One pass without backtracking tells which texts can hold anything.
            maybe = pc.or_(pc.match_substring_regex(texts, f"[{_SYMBOLS}]{{{RUN}}}"), pc.match_substring_regex(texts, ASSIGN, ignore_case=True))
            found = [of(t.as_py()) if m else [] for t, m in zip(texts, maybe.to_pylist(), strict=True)]
            rows = [[dict(zip(("kind", "start", "end", "value"), s, strict=True)) for s in x] for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, _SPAN_TYPE)], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found {_SPANS}")


Transitions = list[dict[str, int]]
#: How often each character comes next: after a state (key ``""``), and after the state and the character that is the key.
Following = dict[str, Counter]


def tally(following: Transitions, strings: Iterable[str]) -> Counter:
    """``(state, step, ahead)`` and how often ``ahead`` comes after the state or, with a step, after the new state it leads to."""
    out: Counter = Counter()
    for s in strings:
        at, ended = 0, s + _END
        for k, c in enumerate(ended):
            out[at, "", ended[k:k + AHEAD]] += 1
            if c == _END:
                break
            if c not in following[at]:
                out[at, c, ended[k + 1:k + 1 + AHEAD]] += 1
                break
            at = following[at][c]
    return out


def _gap(a: Following, b: Following) -> float:
    """How far frequencies differ beyond the bound; compatible states have no gap above zero."""
    most = -math.inf
    for key in a.keys() & b.keys():
        x, y = a[key], b[key]
        n, m = x.total(), y.total()
        bound = _BOUND * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        most = max(most, max(abs(x[c] / n - y[c] / m) for c in x.keys() | y.keys()) - bound)
    return most


class Automaton:
    """A probabilistic automaton inferred from strings by merging compatible prefix-tree states.

    ``grow`` takes the tallies of all strings by the states so far; it is called until nothing is new.
    """

    def __init__(self, strings: Iterable[str] = ()):
        self.next: Transitions = [{}]
        self._set([{"": Counter()}])
        while self.grow(tally(self.next, strings).items()):
            pass

    def _set(self, known: list[Following]) -> None:
        self.count = [x[""].total() for x in known]
        self.ends = [x[""][_END] for x in known]
        self.passed = [{c: n for c, n in x[""].items() if c != _END} for x in known]

    def grow(self, counts: Iterable[tuple[tuple[int, str, str], int]]) -> bool:
        """Gives each new state of the counts its place; whether there was any."""
        trees: dict[tuple[int, str], Following] = {}
        for (state, step, ahead), n in counts:
            tree = trees.setdefault((state, step), {"": Counter()})
            tree[""][ahead[0]] += n
            if ahead[1:]:
                tree.setdefault(ahead[0], Counter())[ahead[1]] += n
        known = [trees.pop((q, ""), {"": Counter()}) for q in range(len(self.next))]
        # Every string ends in a known state or leaves for a new one.
        self.strings = sum(x[""][_END] for x in known) + sum(x[""].total() for x in trees.values())
        self._set(known)
        for (state, step), tree in sorted(trees.items(), key=lambda x: (-x[1][""].total(), x[0])):
            gaps = []
            for q in known:
                gaps.append(_gap(q, tree))
                if gaps[-1] <= 0:
                    break
            if gaps[-1] > 0 and tree[""].total() >= SHARE * self.strings:
                self.next[state][step] = len(known)
                self.next.append({})
                known.append(tree)
            else:
                self.next[state][step] = place = gaps.index(min(gaps))
                for key, x in tree.items():
                    known[place].setdefault(key, Counter()).update(x)
        return bool(trees)

    def log_likelihood(self, s: str) -> float:
        """Natural logarithm of the probability of the string, with a little left for what was not seen."""
        total, at = 0.0, 0
        for c in s:
            n = self.count[at] + _SMOOTH
            total += math.log((self.passed[at].get(c, 0) + _SMOOTH / _ALPHABET) / n)
            at = self.next[at].get(c, 0)
        return total + math.log((self.ends[at] + _SMOOTH / _ALPHABET) / (self.count[at] + _SMOOTH))


def _tallies(strings: DataFrame, following: list[Transitions]) -> DataFrame:
    """``(kind, state, step, ahead, n)`` over all ``strings`` of each kind."""
    names = ["kind", "state", "step", "ahead", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, states in enumerate(following):
                found = tally(states, b.column(1).filter(pc.equal(b.column(0), kind)).to_pylist())
                rows = [(kind, *key, n) for key, n in found.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)

    made = strings.select("kind", "value").mapInArrow(run, "kind long, state long, step string, ahead string, n long")
    return made.groupBy(*names[:4]).agg(F.sum("n").alias("n"))


def learn(found: DataFrame) -> tuple[list[Automaton], Automaton]:
    """One automaton per rule that found anything, and that of ordinary runs, each from all different strings of its kind."""
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.value")
    values = spans.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    # A run with digits that stands once may be a secret itself: ordinary runs with digits are those that come again.
    strings = stored(values.filter("kind < 3 OR n > 1 OR NOT value RLIKE '[0-9]'").select("kind", "value"))
    models = [Automaton() for _ in KINDS]
    more = True
    while more:
        sums: list[list] = [[] for _ in KINDS]
        for kind, *key, n in zip(*_tallies(strings, [m.next for m in models]).toArrow().to_pydict().values(), strict=True):
            sums[kind].append((tuple(key), n))
        more = any([m.grow(x) for m, x in zip(models, sums, strict=True)])
    return [m for m in models[:3] if m.strings], models[3]


def format_score(run: str, formats: list[Automaton], ordinary: Automaton) -> float:
    if not formats:
        return -math.inf
    return (max(a.log_likelihood(run) for a in formats) - ordinary.log_likelihood(run)) / (len(run) + 1)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, secrets)``: every span with its kind, place, credential and, for learned formats, score."""
    found = stored(scan(docs))
    formats, ordinary = learn(found)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scored(spans: list[dict]) -> list[dict]:
        out = []
        for s in spans:
            score = None
            if s["kind"] == 3:
                if not (re.search("[0-9]", s["value"]) and re.search("[A-Za-z]", s["value"])):
                    continue
                score = format_score(s["value"], formats, ordinary)
                if score < THRESHOLD:
                    continue
            out.append(s | {"score": score})
        return sorted(out, key=lambda s: (s["start"], s["kind"]))

    made = pa.list_(pa.struct([*_SPAN_TYPE.value_type, ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([scored(x) for x in b.column(1).to_pylist()], made)], ["doc_id", "secrets"])

    return found.mapInArrow(run, f"doc_id {kind}, secrets {_SPANS[:-2]},score:double>>")
