"""Subject areas of documents: seeded non-negative factorisation of the sentence-term matrix.

Documents are split into sentences, the rows of a matrix of term counts (words, and pairs of neighbouring words). It is
factored as W H with non-negative factors: one anchored component per subject and a few of background, which take up what
sentences of any subject share, chatter and figures of speech included. Multiplicative updates that lessen the generalised
Kullback-Leibler divergence alternate between W and H.

Seeding: in the hand-labelled documents, a term anchors a subject if of the documents with the term a share of at least
``ANCHOR`` (one document's worth of the subject's base rate added) carries the label. Components start from their anchors'
document counts and are zero elsewhere, and zeros stay zero under the updates; anchors of ``EXCLUSIVE`` or more are zero
in the background. While H is fitted, a sentence of a labelled document may load only on that document's subjects and the
background, so that wrong labels and stray sentences are outweighed.

H is fitted on at most ``FIT_DOCS`` labelled documents, whole, chosen by a hash of their id (the bounded sample of labelled
rows that a classifier may be fitted on); a subject without labels is seeded by its
description. With H fixed, W is then solved for every sentence of every document, whole texts, in Arrow batches. A
component's mass in a sentence is the number of terms it explains. A sentence deals with the subject of the greatest
mass if that is ``MASS`` terms or more (just under two, so that rounding doesn't decide about sentences of two anchors).
A sentence is solved when a round moves none of its masses by more than ``SETTLED``, by its own movement alone, however many
rounds it takes; where less than ``NEAR`` decides, it is solved a thousand times as far. ``SOLVE_ROUNDS`` is a far safety stop,
and sentences that reach it are counted in ``n_unsettled``. A document has a subject if two of its sentences deal with it, or one in a
document of fewer than ``SHORT`` sentences.

Defined results: null and empty texts have no sentences and no subject; repeated texts get the same subjects each; very
long texts are worked through whole; labels of unknown documents or subjects are ignored; without labels and descriptions
nothing is found; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import c
from tidemark.session import spread, staged

FIT_DOCS = 3000
ANCHOR, EXCLUSIVE, MASS, SHORT = 0.5, 0.6, 1.9, 6
BACKGROUND, FIT_ROUNDS, SOLVE_ROUNDS, SETTLED = 6, 40, 10_000, 1e-3
#: Entries of a block of sentences, so that its share of H stays in a core's cache; and what keeps quotients finite.
BLOCK, TINY = 25_000, 1e-12
#: Sentences whose decision hangs on less than this mass are solved to a thousandth of SETTLED.
NEAR = 0.5

WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
ASCII_WORD = re.compile(r"[A-Za-z]+(?:-[A-Za-z]+)*")
MARKUP = re.compile(r"<[^<>]{1,40}>")
BREAK = re.compile(r"(?<=[.!?])\s+|\n+")


def words(text: str | None) -> list[list[str]]:
    """The words of each sentence as they stand; fewer than three (numbering, say) make none. Sentences all in capitals are put in lower case."""
    out = []
    for s in BREAK.split(MARKUP.sub(" ", text or "")):
        own = (ASCII_WORD if s.isascii() else WORD).findall(s)
        if len(own) > 2:
            out.append([x.lower() for x in own] if s.isupper() else own)
    return out


def counted(word: str) -> str | None:
    """A word as it is counted: in lower case. Upper-case codes are no words: they part their neighbours, as None."""
    return None if len(word) > 2 and word.isupper() else word.lower()


def sentences(text: str | None) -> list[list[str]]:
    """The terms of each sentence: its words, and pairs of neighbouring words."""
    return [[x for x in w if x] + [f"{a} {b}" for a, b in zip(w, w[1:]) if a and b] for w in ([counted(x) for x in own] for own in words(text))]


class _Lookup(dict):
    """Words as they stand to (their term's number or -1, the numbers of pairs by second word or None, the word as counted); kept up to a bound, as texts repeat their words."""

    def __init__(self, voc: dict[str, int]):
        super().__init__()
        self.voc, self.pairs = voc, {}
        for x, i in voc.items():
            a, _, b = x.partition(" ")
            if b:
                self.pairs.setdefault(a, {})[b] = i

    def __missing__(self, x: str) -> tuple[int, dict[str, int] | None, str | None]:
        if len(self) > 200_000:
            self.clear()
        y = counted(x)
        self[x] = found = (self.voc.get(y, -1), self.pairs.get(y), y)
        return found

    def terms(self, own: list[str]) -> list[int]:
        """The numbers of a sentence's terms, in order."""
        ids, seconds = [], None
        for x in own:
            i, following, y = self[x]
            if i >= 0:
                ids.append(i)
            if seconds is not None and y in seconds:
                ids.append(seconds[y])
            seconds = following
        ids.sort()
        return ids


def _blocks(keys: list[tuple[int, ...]], pad: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sentences of like length together: their places in keys, and their terms as a matrix filled up with pad."""
    order = sorted(range(len(keys)), key=lambda i: len(keys[i]))
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * len(keys[order[j]]) <= BLOCK:
            j += 1
        part = order[i:j]
        ids = np.full((len(part), len(keys[part[-1]])), pad)
        for row, k in zip(ids, part):
            row[: len(keys[k])] = keys[k]
        yield np.array(part), ids
        i = j


def _padded(h: np.ndarray) -> np.ndarray:
    """H by term, with a last term of no weight."""
    return np.ascontiguousarray(np.concatenate([h, np.zeros((len(h), 1))], axis=1).T)


def solve(h: np.ndarray, keys: list[tuple[int, ...]], rounds: int = SOLVE_ROUNDS, tol: float = SETTLED) -> np.ndarray:
    """W for given H; its rows add up to the sentences' numbers of known terms."""
    return solved(h, keys, rounds, tol)[0]


def solved(h: np.ndarray, keys: list[tuple[int, ...]], rounds: int = SOLVE_ROUNDS, tol: float = SETTLED) -> tuple[np.ndarray, np.ndarray]:
    """W, and whether each of its rows has settled: it stays as it is from the first round on that moves it by tol at most."""
    out, by_term, rests = np.ones((len(keys), len(h))), _padded(h), np.zeros(len(keys), bool)
    for part, ids in _blocks(keys, h.shape[1]):
        a, w, live = by_term[ids], np.ones((len(part), len(h))), np.arange(len(part))
        open_ = np.ones(len(part), bool)
        for _ in range(rounds):
            old = w[live]
            q = np.matmul(a, old[:, :, None])[:, :, 0] + TINY
            new = old * np.matmul((1 / q)[:, None, :], a)[:, 0]
            moving = np.abs(new - old).max(axis=1) > tol
            on = open_[live]
            w[live[on]] = new[on]
            open_[live[on & ~moving]] = False
            if (left := open_[live]).mean() < 0.7:  # else taking the settled out costs more than it saves
                live, a = live[left], a[left]
                if not len(live):
                    break
        out[part], rests[part] = w, ~open_
    return out, rests


def factor(docs: list[tuple[list[list[str]], set[int]]], n_subjects: int, rounds: int = FIT_ROUNDS) -> tuple[list[str], np.ndarray]:
    """Terms and H (components x terms) from documents' sentences and subjects."""
    seen = Counter(x for s, _ in docs for terms in s for x in set(terms))
    voc = {x: i for i, x in enumerate(sorted(x for x, n in seen.items() if n > 1))}
    size, total = len(voc), n_subjects + BACKGROUND
    with_subject, with_term, base = np.zeros((n_subjects, size)), np.zeros(size), np.zeros(n_subjects)
    alike: Counter = Counter()  # sentences of equal terms and subjects are one row, with their number
    for terms, subjects in docs:
        own = list({voc[x] for s in terms for x in s if x in voc})
        with_term[own] += 1
        for k in subjects:
            base[k] += 1
            with_subject[k, own] += 1
        for s in terms:
            alike[tuple(sorted(voc[x] for x in s if x in voc)), tuple(sorted(subjects))] += 1
    keys, rows, times = [k for k, _ in alike], [s for _, s in alike], np.array(list(alike.values()), float)
    often = np.bincount(np.array([i for k in keys for i in k], np.int64), np.repeat(times, [len(k) for k in keys]), minlength=size)
    sure = (with_subject + base[:, None] / max(len(docs), 1)) / (with_term + 1)
    h = np.zeros((total, size))
    h[:n_subjects] = np.where(sure >= ANCHOR, with_subject, 0)
    rng = np.random.default_rng(0)
    free = often * ~(sure >= EXCLUSIVE).any(axis=0)
    h[n_subjects:] = free * rng.uniform(0.5, 1.5, (BACKGROUND, size))
    w = np.zeros((len(rows), total))
    w[:, n_subjects:] = 1
    for i, subjects in enumerate(rows):
        w[i, list(subjects)] = 1
    scale = lambda x: x / np.maximum(x.sum(axis=1, keepdims=True), 1e-12)
    h = scale(h)
    blocks = list(_blocks(keys, size))
    entries = np.concatenate([ids.ravel() for _, ids in blocks]) if blocks else np.zeros(0, np.int64)
    owners = np.concatenate([np.repeat(part, ids.shape[1]) for part, ids in blocks]) if blocks else entries
    # entries in order of term, in pieces that stay in the caches; padding is no entry
    order = np.argsort(entries, kind="stable")
    order = order[: np.searchsorted(entries[order], size)]
    heads = np.flatnonzero(np.r_[True, np.diff(entries[order]) != 0]) if len(order) else np.zeros(0, np.int64)
    present, often_ = entries[order][heads], times[owners[order]] if len(order) else np.zeros(0)
    cuts = [0]
    for x in heads[1:]:
        if x - cuts[-1] >= BLOCK:
            cuts.append(int(x))
    cuts.append(len(order))
    for _ in range(rounds):
        by_term, inverse = _padded(h), []
        for part, ids in blocks:
            a = by_term[ids]
            q = np.matmul(a, w[part][:, :, None])[:, :, 0] + TINY
            w[part] *= np.matmul((1 / q)[:, None, :], a)[:, 0]
            inverse.append((1 / (np.matmul(a, w[part][:, :, None])[:, :, 0] + TINY)).ravel())
        share = np.zeros((size, total))
        if len(order):
            weight = np.concatenate(inverse)[order] * often_
            for a, b in zip(cuts, cuts[1:]):
                here = (heads >= a) & (heads < b)
                share[present[here]] = np.add.reduceat(w[owners[order[a:b]]] * weight[a:b, None], heads[here] - a, axis=0)
        h = scale(h * share.T)
    return sorted(voc), h


def fit(docs: DataFrame, labels: DataFrame, subjects: list[str], descriptions: dict[str, str]) -> tuple[list[str], np.ndarray]:
    """H from a bounded sample of the labelled documents (doc_id, text) and (doc_id, subject)."""
    known = labels.filter(c("subject").isin(subjects)).select("doc_id", "subject").distinct()
    ids = known.groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))  # at most all subjects
    ids = ids.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    # written, so that the planner sees how small it is: texts are read for these documents alone
    sample = docs.select("doc_id", "text").join(staged(ids, "labelled"), "doc_id").select("text", "subjects")
    at = {s: k for k, s in enumerate(subjects)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += [(sentences(t), {at[x] for x in s}) for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        rows.sort(key=lambda x: (sorted(x[1]), x[0]))  # the same sums whatever the order of arrival
        labelled = {k for _, s in rows for k in s}
        rows += [(sentences(descriptions.get(s)), {k}) for s, k in at.items() if k not in labelled for _ in (0, 1)]
        terms, h = factor(rows, len(subjects))
        for i in range(0, len(terms), 4096):
            part = pa.FixedSizeListArray.from_arrays(pa.array(h[:, i : i + 4096].T.ravel()), len(h)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(terms[i : i + 4096], pa.string()), part], names=["term", "weights"])

    # one task, as the sample is bounded; so is the number of its terms
    model = staged(sample.repartition(1).mapInArrow(run, "term string, weights array<double>"), "subjects").orderBy("term").collect()
    h = np.array([r[1] for r in model]).T if model else np.zeros((len(subjects) + BACKGROUND, 0))
    return [r[0] for r in model], h


class _Reader:
    """Finds sentences' subjects. Sentences of the same known terms are solved once."""

    def __init__(self, terms: list[str], h: np.ndarray, n: int):
        self.voc, self.h, self.n = {x: i for i, x in enumerate(terms)}, h, n
        self.speaks = (h[:n] > 0).any(axis=0).tolist()
        self.lookup = _Lookup(self.voc)
        self.known: dict[tuple, int] = {}
        self.unsettled: set[tuple] = set()

    def read(self, texts: list[str | None]) -> tuple[list[list[int]], list[int]]:
        """Per text and sentence the subject's number, or -1; per text the sentences that haven't settled."""
        keys = []
        for text in texts:
            own = []
            for w in words(text):
                ids = self.lookup.terms(w)
                # without any anchor all mass is the background's
                own.append(tuple(ids) if any(self.speaks[i] for i in ids) else ())
            keys.append(own)
        new = list(dict.fromkeys(k for own in keys for k in own if k and k not in self.known))
        if len(self.known) + len(new) > 200_000:
            self.known.clear()
            self.unsettled.clear()
            new = list(dict.fromkeys(k for own in keys for k in own if k))
        w, rests = solved(self.h, new) if new else (np.zeros((0, self.n)), np.zeros(0, bool))
        mass = w[:, : self.n].copy()
        # where the decision may still turn, on to the end: at MASS, and between subjects of like mass
        ordered = np.sort(np.concatenate([mass, np.zeros((len(mass), 2))], axis=1), axis=1)
        top, second = ordered[:, -1], ordered[:, -2]
        near = np.flatnonzero((np.abs(top - MASS) < NEAR) | ((top > MASS - NEAR) & (top - second < NEAR)))
        if len(near):
            w, rests[near] = solved(self.h, [new[i] for i in near], tol=SETTLED / 1000)
            mass[near] = w[:, : self.n]
        best = mass.argmax(axis=1) if new else []
        self.unsettled.update(new[i] for i in np.flatnonzero(~rests))
        self.known.update(zip(new, np.where(mass.max(axis=1, initial=0) >= MASS, best, -1).tolist()))
        return [[self.known[k] if k else -1 for k in own] for own in keys], [sum(k in self.unsettled for k in own) for own in keys]


#: The reader of the model that this worker process used last, by the model's content: later tasks find its sentences solved.
_readers: dict[str, _Reader] = {}


def _reader(key: str, model) -> _Reader:
    if key not in _readers:
        _readers.clear()
        _readers[key] = _Reader(*model.value)
    return _readers[key]


def subject_sentences(docs: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, n_unsettled, and per subject that any sentence deals with: subjects (subject, n), found (subjects that count)."""
    # a fixed table of subjects
    described = {r[0]: r[1] for r in areas.select("subject", "description").collect() if r[0] is not None}
    subjects = sorted(described)
    spark = docs.sparkSession
    terms, h = fit(docs, labels, subjects, described)
    model = spark.sparkContext.broadcast((terms, h, len(subjects)))
    key = hashlib.sha256("\n".join(terms).encode() + h.tobytes()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(key, model)
        for b in batches:
            got, unsettled = reader.read(b.column(1).to_pylist())
            counts = [Counter(x for x in own if x >= 0) for own in got]
            n = [len(x) for x in got]
            named = [[{"subject": subjects[k], "n": m} for k, m in sorted(x.items())] for x in counts]
            found = [[subjects[k] for k, m in sorted(x.items()) if m > 1 or size < SHORT] for x, size in zip(counts, n)]
            kind = pa.list_(pa.struct([("subject", pa.string()), ("n", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(named, kind), pa.array(found, pa.list_(pa.string())), pa.array(unsettled, pa.int32())],
                names=["doc_id", "n_sentences", "subjects", "found", "n_unsettled"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_sentences int, subjects array<struct<subject: string, n: int>>, found array<string>, n_unsettled int")
