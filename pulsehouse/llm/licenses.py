"""License scans by template matching.

A template is wording with mark-up:

* plain words are mandatory and must stand as written;
* ``<<beginOptional>> ... <<endOptional>>`` encloses wording that may be left out (nested
  regions are allowed);
* ``<<var;name="x";words="1-4">>`` stands for 1 to 4 words of any kind, and with
  ``match="regex"`` each of them must match the expression.

Every template is compiled into a token automaton over a text's words (runs of ASCII
digits, letters with A-Z lower-cased, and all characters beyond ASCII). An automaton runs
from each word that can begin its template and accepts the longest run of words in which
all mandatory wording matches exactly.

Defined results: a null text is an empty text, with 0 words and no place; repeated rows
stay; an empty table gives an empty result. A place is reported for every start from which
a template is accepted, overlapping ones too. Texts are read whole; other columns are not
read. Templates must begin with a mandatory or optional word, or ValueError is raised.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.common import shown

#: A-Z to a-z; all other ASCII characters but digits and letters to a blank.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
               else 32 for b in range(256))
_MARK = re.compile(r"<<(beginOptional|endOptional|var)((?:;\w+=\"[^\"]*\")*)>>")

# The phrases and labels of the base scan.
BASE = (("mit license", "mit"), ("apache license", "apache"),
        ("general public license", "gpl"))

# Wording of common notices, with mark-up.
NOTICES = (
    ("licensed under the apache license <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>0<<endOptional>>",
     "apache-2.0"),
    ("<<beginOptional>>gnu<<endOptional>> general public license <<beginOptional>>as published by the "
     "free software foundation either<<endOptional>> <<beginOptional>>version<<endOptional>> "
     "<<var;name=\"version\";words=\"1-1\";match=\"v?[23]\">> <<beginOptional>>0<<endOptional>> "
     "<<beginOptional>>of the license<<endOptional>> <<beginOptional>>or <<beginOptional>>at your option"
     "<<endOptional>> any later version<<endOptional>>", "gpl-notice"),
    ("released under the <<var;name=\"holder\";words=\"0-3\">> mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this "
     "<<var;name=\"work\";words=\"1-12\">> to deal in <<var;name=\"work\";words=\"1-4\">> without restriction",
     "mit-grant"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "<<beginOptional>>provided that the following conditions are met<<endOptional>>", "bsd"),
    ("licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc "
     "<<var;name=\"terms\";words=\"1-3\";match=\"by|nc|nd|sa|0\">> <<var;name=\"version\";words=\"1-2\";match=\"[0-9]\">>",
     "creative-commons"),
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass
class Automaton:
    """Token automaton of one template; state numbers are places in ``steps``."""
    label: str
    base: bool
    #: state -> (word or compiled expression or None for any word, next state)
    steps: list[list[tuple[object, int]]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)    # moves without a word
    end: int = 0
    mandatory: int = 0

    def _state(self) -> int:
        self.steps.append([])
        self.free.append(set())
        return len(self.steps) - 1

    def reach(self, states: set[int]) -> frozenset[int]:
        todo, found = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - found:
                found.add(s)
                todo.append(s)
        return frozenset(found)

    def run(self, words: Sequence[bytes], start: int) -> int | None:
        """The end of the longest accepted run from ``start``; None if there is none."""
        now, best = self.first, None
        for at in range(start, len(words)):
            w, after = words[at], set()
            for s in now:
                for want, to in self.steps[s]:
                    if want is None or want == w or (isinstance(want, re.Pattern) and want.fullmatch(w)):
                        after.add(to)
            if not after:
                break
            now = self.reach(after)
            if self.end in now:
                best = at + 1
        return best

    def close(self) -> None:
        self.first = self.reach({0})
        if self.end in self.first:
            raise ValueError(f"template {self.label!r} has no mandatory wording")
        openers = [want for s in self.first for want, _ in self.steps[s]]
        if any(not isinstance(x, bytes) for x in openers):
            raise ValueError(f"template {self.label!r} must begin with a word")
        self.openers = frozenset(openers)


def compile_template(wording: str, label: str, base: bool = False) -> Automaton:
    a = Automaton(label, base)
    here, opened, at = a._state(), [], 0
    for m in [*_MARK.finditer(wording), None]:
        for w in words_of(wording[at:m.start() if m else len(wording)]):
            to = a._state()
            a.steps[here].append((w, to))
            here = to
            a.mandatory += not opened
        if m is None:
            break
        at = m.end()
        given = dict(re.findall(r";(\w+)=\"([^\"]*)\"", m[2]))
        if m[1] == "beginOptional":
            opened.append(here)
            to = a._state()
            a.free[here].add(to)
            here = to
        elif m[1] == "endOptional":
            if not opened:
                raise ValueError(f"template {label!r}: endOptional without its begin")
            to = a._state()
            a.free[here].add(to)
            a.free[opened.pop()].add(to)
            here = to
        else:
            low, high = map(int, given.get("words", "1-1").split("-"))
            want = re.compile(given["match"].encode()) if "match" in given else None
            stops = [here] if low == 0 else []
            for k in range(1, high + 1):
                to = a._state()
                a.steps[here].append((want, to))
                here = to
                if k >= low:
                    stops.append(here)
            to = a._state()
            for s in stops:
                a.free[s].add(to)
            here = to
    if opened:
        raise ValueError(f"template {label!r}: an optional region is not closed")
    a.end = here
    a.close()
    return a


def compile_all(base=BASE, notices=NOTICES) -> list[Automaton]:
    return ([compile_template(w, label, True) for w, label in base]
            + [compile_template(w, label) for w, label in notices])


class Scanner:
    def __init__(self, automata: Sequence[Automaton]) -> None:
        self.by_word: dict[bytes, list[Automaton]] = {}
        for a in automata:
            for w in a.openers:
                self.by_word.setdefault(w, []).append(a)
        self.openers = frozenset(self.by_word)

    def places(self, words: Sequence[bytes]) -> list[tuple[str, bool, int, int, int]]:
        """(label, of the base, start, end, mandatory words) of every accepted place."""
        if self.openers.isdisjoint(words):
            return []
        out = []
        for i, w in enumerate(words):
            for a in self.by_word.get(w, ()):
                end = a.run(words, i)
                if end is not None:
                    out.append((a.label, a.base, i, end, a.mandatory))
        return out


PLACE = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()),
                   ("end", pa.int64()), ("mandatory", pa.int64())])


def scan(documents: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """doc_id, n_words, places (array of label, base, start, end, mandatory words): one row
    for each row of ``documents``. A place's words are numbered from 0, end excluded."""
    compile_all(base, notices)    # a wrong template fails here, not in a task

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(compile_all(base, notices))
        names = [f.name for f in PLACE]
        for b in batches:
            counts, found = [], []
            for text in b.column("text").to_pylist():
                words = words_of(text)
                counts.append(len(words))
                found.append([dict(zip(names, p)) for p in scanner.places(words)])
            yield pa.record_batch({"doc_id": b.column("doc_id"),
                                   "n_words": pa.array(counts, pa.int64()),
                                   "places": pa.array(found, pa.list_(PLACE))})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), shown("text").alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_words long, places array<struct<label: string, "
                                 "base: boolean, start: long, end: long, mandatory: long>>")


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the scan's report. score: m / (m + 1) for the most mandatory words m
    of a template accepted in the text; 0 without one."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    labels = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(
        F.transform(places, lambda p: p["label"]))))
    most = F.coalesce(F.array_max(F.transform("places", lambda p: p["mandatory"])), F.lit(0))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        (most / (most + 1)).cast("double").alias("score"))
