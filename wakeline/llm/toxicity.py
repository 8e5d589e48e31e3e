"""Toxicity by the nearest labelled texts: exact TF-IDF cosine, found with a block-max inverted index.

Terms are lower-case words and their beginnings. The index's terms are those that set the toxic examples apart from the clean
ones beyond chance (log-likelihood ratio); over all words of a text the cosine is mostly its subject. Labelled examples are a
bounded sample of the labelled rows; there is no bound on the terms, and their document frequencies come from all
documents. A text's vector holds (1 + ln tf) * idf for these terms, at length one. The examples' index keeps postings
in blocks of BLOCK examples with each block's largest weight, so that most blocks are ruled out unseen, and the
nearest examples found are exactly the nearest. Their votes, weighted by distance, are mapped to a calibrated score by
an isotonic fit on the examples themselves. No text has a vote on itself: examples with the same text are left out, in the
fit and in the scores. The neighbours are returned as evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, durable

#: The bound on labelled rows that are learnt from (those with the smallest hashes of their ids).
MAX_EXAMPLES = 20_000
#: What sets a term apart, at any size of the sample: a log-likelihood ratio that chance alone gives to one term of a million, and
#: so many times the clean examples' share of texts. Without the second, words of long texts and of single languages pass.
LEAST_GAIN, LEAST_RATIO = 24.0, 3.0
NEIGHBOURS, PRIOR_VOTES, BLOCK = 25, 0.5, 32
_WORD = re.compile(r"\w+")
_KEPT_WORDS, _KEPT_SCORES = 150_000, 4000


def word_terms(word: str) -> list[str]:
    """The terms of a lower-case word: itself and its beginnings of three to eight letters."""
    return [word, *("^" + word[:k] for k in range(3, 9) if len(word) > k)]


class Terms:
    """Counts known terms in texts; what a word gives is kept for the next time."""

    def __init__(self, terms: list[str]):
        self.index = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def count(self, text: str) -> Counter:
        found: Counter = Counter()
        known, index = self.known, self.index
        for word in _WORD.findall(text.lower()):
            ids = known.get(word)
            if ids is None:
                ids = tuple(index[t] for t in word_terms(word) if t in index)
                if len(known) >= _KEPT_WORDS:
                    known.clear()
                if len(word) <= 64:
                    known[word] = ids
            if ids:
                found.update(ids)
        return found


class BlockMaxIndex:
    """Exact nearest neighbours by cosine among unit vectors {term: weight}."""

    def __init__(self, vectors: list[dict[int, float]], block: int = BLOCK):
        self.block, self.n = block, len(vectors)
        self.blocks = -(-self.n // block)
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for i, v in enumerate(vectors):
            for t, x in v.items():
                postings[t].append((i, x))
        self.ids = {t: np.array([i for i, _ in p], np.int64) for t, p in postings.items()}
        self.weights = {t: np.array([x for _, x in p]) for t, p in postings.items()}
        self.at, self.most, self.length = {}, {}, {}
        for t, ids in self.ids.items():
            start = np.flatnonzero(np.diff(ids // block, prepend=-1))
            self.at[t], self.most[t], self.length[t] = ids[start] // block, np.maximum.reduceat(self.weights[t], start), np.diff(np.append(start, len(ids)))

    def nearest(self, query: dict[int, float], k: int, but: Collection[int] = ()) -> list[tuple[float, int]]:
        """The k (cosine, index) with the highest cosines above zero, ties to the smaller index; never those of `but`.

        Blocks with the largest bounds are scored first, so many that they hold 4 k examples; the k-th best of these is a limit
        that rules out all blocks whose bound is below it, and what is left is scored as well."""
        upper = np.zeros(self.blocks)
        terms = [(t, x) for t, x in query.items() if t in self.ids]
        for t, x in terms:
            upper[self.at[t]] += x * self.most[t]
        score = np.zeros(self.blocks * self.block)
        first = -(-(4 * k + len(but)) // self.block)
        chosen = np.zeros(self.blocks, bool)
        chosen[np.argpartition(-upper, first)[:first] if first < self.blocks else slice(None)] = True
        self._add(score, terms, chosen)
        score[list(but)] = 0
        limit = np.partition(score, -k)[-k] if k < len(score) else 0.0
        rest = (upper >= max(limit - 1e-12, 1e-300)) & ~chosen
        if rest.any():
            self._add(score, terms, rest)
            score[list(but)] = 0
        found = np.flatnonzero(score > 0 if limit <= 0 else score >= limit - 1e-12)
        return [(float(score[i]), int(i)) for i in found[np.argsort(-score[found], kind="stable")][:k]]

    def _add(self, score: np.ndarray, terms: list[tuple[int, float]], chosen: np.ndarray) -> None:
        for t, x in terms:
            keep = chosen[self.at[t]]
            if keep.any():
                part = np.repeat(keep, self.length[t])
                score[self.ids[t][part]] += x * self.weights[t][part]


def fingerprint(text: str) -> bytes:
    return xxhash.xxh128_digest(text.encode("utf-8", "surrogatepass"))


@dataclass
class Model:
    terms: list[str]
    idf: list[float]
    ids: list[int]
    labels: list[int]
    vectors: list[dict[int, float]]
    prints: list[bytes]
    empty_rate: float
    base_rate: float
    knots: tuple[list[float], list[float]] = field(default_factory=lambda: ([0.0, 1.0], [0.0, 1.0]))

    def start(self) -> Model:
        self.counter = Terms(self.terms)
        self.index = BlockMaxIndex(self.vectors)
        self.kept: dict = {}
        self.same: dict[bytes, list[int]] = defaultdict(list)
        for i, x in enumerate(self.prints):
            self.same[x].append(i)
        return self

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        v = {t: (1 + math.log(n)) * self.idf[t] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def vote(self, vector: dict[int, float], but: Collection[int] = ()) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(vector, NEIGHBOURS, but)
        weights = [1 / (1.05 - s) for s, _ in near]
        yes = sum(w for w, (_, i) in zip(weights, near) if self.labels[i])
        return (yes + PRIOR_VOTES * self.base_rate) / (sum(weights) + PRIOR_VOTES), near

    def score(self, text: str) -> tuple[float, list[tuple[float, int]]]:
        """The score depends on the text alone."""
        counts = self.counter.count(text)
        if not counts:
            return self.empty_rate, []
        but = self.same.get(fingerprint(text), ())
        key = (tuple(sorted(counts.items())), tuple(but))
        got = self.kept.get(key)
        if got is None:
            raw, near = self.vote(self.vector(counts), but)
            got = float(np.interp(raw, *self.knots)), near[:3]
            if len(self.kept) >= _KEPT_SCORES:
                self.kept.clear()
            self.kept[key] = got
        return got


def isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of a rising line from raw votes to the share of toxic examples (pool adjacent violators, smoothed)."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(raw[order], labels[order]):
        pools.append([x, x, float(y), 1.0])
        while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
            _, hi, y1, n1 = pools.pop()
            pools[-1] = [pools[-1][0], hi, pools[-1][2] + y1, pools[-1][3] + n1]
    xs, ys = [], []
    for lo, hi, y, n in pools:
        xs += [lo, hi]
        ys += [(y + (lo + hi) / 2) / (n + 1)] * 2
    if not xs:
        return [0.0, 1.0], [0.0, 1.0]
    return xs, np.maximum.accumulate(np.clip(ys, 0, 1)).tolist()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for whole in batches:
        for lo in range(0, len(whole), 256):
            batch = whole.slice(lo, 256)
            yield batch, [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]


def _document_frequencies(batches, terms: list[str]):
    counter, found = Terms(terms), Counter()
    texts = 0
    for _, part in _texts(batches):
        for text in part:
            found.update(counter.count(text).keys())
        texts += len(part)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *found], pa.int64()), pa.array([texts, *found.values()], pa.int64())], ["term", "n"])


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model of bounded size from labelled (ids and labels 0 or 1 of rows to learn from; the sample) and docs (all rows)."""
    spark = docs.sparkSession
    sample = labelled.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    rows = sample.orderBy(F.xxhash64("id"), "id").limit(MAX_EXAMPLES).collect()
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if not rows:
        return Model([], [], [], [], [], [], 0.0, 0.0)
    few = F.broadcast(spark.createDataFrame([tuple(r) for r in rows], "id long, y int"))  # MAX_EXAMPLES rows at most
    texts = durable(base.join(few, "id").select("y", "id", "text"))
    model = _fitted(base, texts)
    discard(texts)
    return model


def gain(a: int, b: int, toxic: int, clean: int) -> float:
    """The log-likelihood ratio of a term in a of the toxic and b of the clean examples; 0 if it is not LEAST_RATIO times as frequent in toxic ones."""
    if a * clean < LEAST_RATIO * b * toxic:
        return math.inf if a and not clean else 0.0
    share = (a + b) / (toxic + clean)
    return 2 * (a * math.log(a / (toxic * share)) + (b * math.log(b / (clean * share)) if b else 0))


def _fitted(base: DataFrame, texts: DataFrame) -> Model:
    """The model of the examples in texts (y, id, text); base has all documents' texts."""
    sizes = {int(r.y): r.n for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    rate = (toxic + 0.5) / (toxic + clean + 1) if toxic + clean else 0.0
    if not toxic:
        return Model([], [], [], [], [], [], rate, rate)

    def toxic_terms(batches):
        found: Counter = Counter()
        for _, part in _texts(batches):
            for text in part:
                found.update({t for w in set(_WORD.findall(text.lower())) for t in word_terms(w)})
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"])

    least = next((a for a in range(1, toxic + 1) if gain(a, 0, toxic, clean) >= LEAST_GAIN), toxic)  # no term in fewer can pass
    counted = texts.filter("y = 1").select("text").mapInArrow(toxic_terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    in_toxic = {r.term: r.n for r in counted.collect()}  # no more than the terms of MAX_EXAMPLES texts
    names = sorted(in_toxic)
    in_clean = Counter()
    for r in texts.filter("y = 0").select("text").mapInArrow(lambda x: _document_frequencies(x, names), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term >= 0:
            in_clean[names[r.term]] = r.n
    terms = [t for t in names if gain(in_toxic[t], in_clean[t], toxic, clean) >= LEAST_GAIN]
    if not terms:
        return Model([], [], [], [], [], [], rate, rate)
    df = Counter({r.term: r.n for r in base.select("text").mapInArrow(lambda x: _document_frequencies(x, terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()})
    model = Model(terms, [math.log((1 + df[-1]) / (1 + df[i])) + 1 for i in range(len(terms))], [], [], [], [], 0.0, rate)

    def examples(batches):
        counter = Terms(terms)
        for batch, part in _texts(batches):
            counts = [sorted(counter.count(x).items()) for x in part]
            lists = [pa.array([[x[k] for x in c] for c in counts], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists, pa.array([fingerprint(x) for x in part], pa.binary())], ["y", "id", "terms", "counts", "print"])

    got = texts.mapInArrow(examples, "y int, id long, terms array<int>, counts array<int>, print binary").collect()  # MAX_EXAMPLES rows at most
    none = Counter(r.y for r in got if not r.terms)
    model.empty_rate = (none[1] + rate) / (none.total() + 1)
    some = sorted((r.terms, r.counts, r.id, r.y, bytes(r.print)) for r in got if r.terms)  # alike examples in one block
    model.ids, model.labels, model.prints = [r[2] for r in some], [r[3] for r in some], [r[4] for r in some]
    model.vectors = [model.vector(dict(zip(r[0], r[1]))) for r in some]
    model.start()
    raw = np.array([model.vote(v, model.same[x])[0] for v, x in zip(model.vectors, model.prints)])
    model.knots = isotonic(raw, np.array(model.labels))
    for name in ("counter", "index", "kept", "same"):
        delattr(model, name)
    return model


def toxicity(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row of docs: its id, score (0 to 1, the chance of label 1), evidence (array of the three nearest examples:
    id, label, cosine).

    labelled holds ids and labels (0 or 1) of the rows to learn from; null ids and labels are left out, an id with
    both labels counts as 1. A text without any of the model's terms (a null or empty one too) gets the share of
    toxic rows among examples without any. Without toxic examples all scores are the smoothed base rate; without any
    examples 0. A score depends on the text alone; examples with the very same text have no vote. Repeated rows are scored alike; an empty table gives an
    empty result; other columns are not read. No shuffle of texts: the bounded model goes to each task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = _scored(rows, fit(docs, labelled, id_col, text_col, label_col), [f"id {kind}"])
    return out.withColumnRenamed("id", id_col)


def reject_toxic(docs: DataFrame, labelled: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of docs, all columns, whose score is below threshold; what toxicity() says of odd rows holds here too."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema)]
    rows = docs.toDF(*names)
    at = docs.columns.index
    rows = rows.select(*names, F.col(names[at(text_col)]).cast("string").alias("text"))
    out = _scored(rows, fit(docs, labelled, id_col, text_col, label_col), kinds).filter(F.col("score") < threshold)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def _scored(rows: DataFrame, model: Model, kinds: list[str]) -> DataFrame:
    """The first columns of rows (named and typed by kinds) with score and evidence; the last is the text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width = len(kinds)

    def score(batches):
        m = shared.value
        if not hasattr(m, "index"):
            m.start()
        for batch, part in _texts(batches):
            got = [m.score(x) for x in part]
            proof = [[{"id": m.ids[i], "label": m.labels[i], "cosine": s} for s, i in near] for _, near in got]
            kind = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
            scores = pa.array([min(1.0, max(0.0, s)) for s, _ in got], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], scores, pa.array(proof, kind)], [*batch.schema.names[:width], "score", "evidence"])

    return rows.mapInArrow(score, ", ".join([*kinds, "score double", "evidence array<struct<id: bigint, label: int, cosine: double>>"]))
