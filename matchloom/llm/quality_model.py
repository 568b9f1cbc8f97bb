"""Quality classifier with hierarchical empirical Bayes.

A document's evidence is the probability of a logistic regression on its words and shapes, fitted to a labelled sample. Hosts and paths (site levels) get posteriors by grouped aggregation: labels where there are
any and evidence elsewhere, shrunk towards the level above with a strength that the spread between the sites gives. A
sparse site stays near its host, and a sparse host near the whole. A document's odds are those of its evidence times those of its
path against the whole; for a document with a label its path's sum has its evidence in place of the label, so that no label speaks for its own document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .secret_scan import runs
from .shared import hash60, stored

_WORDS = 1 << 18
_SHAPES = 8
_STEM = 6
FEATURES = 2 * _WORDS + _SHAPES * 16
CLASSES = ("quality", "toxic")


def _member(chars: bytes, high: bool = False) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    out[128:] = high
    return out


_LETTER = _member(bytes(range(97, 123)), True)
_UPPER = _member(bytes(range(65, 91)))
_SIGN = _member(b"#*$%&|<>!{}[]_=\\^~@")
_DIGIT = _member(b"0123456789")


def features(texts: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """First and last row of a slice, and the distinct features of each row: hashed words (runs of letters, lower-cased) and their first 6 bytes, and shares
    of capitals, signs, digits, distinct words and distinct lines, and lengths, in steps."""
    for lo, hi, data, offsets in tb.slices(texts):
        low = tb.LOWER[data]
        begins, ends = runs(low, offsets, _LETTER, 1)
        words = (tb.word_hash(low, begins, ends) & np.uint64(_WORDS - 1)).astype(np.int64)
        long = ends - begins > _STEM
        stems = (tb.word_hash(low, begins, np.minimum(ends, begins + _STEM)) >> np.uint64(40) & np.uint64(_WORDS - 1)).astype(np.int64)
        at = np.searchsorted(begins, offsets)
        totals = [np.concatenate([[0], np.cumsum(m[data])]) for m in (_UPPER, _SIGN, _DIGIT)]
        out = []
        for i in range(hi - lo):
            a, b = offsets[i], offsets[i + 1]
            own = words[at[i] : at[i + 1]]
            distinct = np.unique(own)
            n, chars = max(1, len(own)), max(1, int(b - a))
            lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
            shares = [(s[b] - s[a]) / chars * 4 for s in totals] + [len(distinct) / n, len(set(lines)) / max(1, len(lines))]
            steps = [min(15, int(15 * min(1.0, x))) for x in shares] + [min(15, int(np.log2(n))), min(15, int((ends[at[i] : at[i + 1]] - begins[at[i] : at[i + 1]]).mean())) if len(own) else 0, min(15, int(np.log2(n / max(1, len(lines)) + 1)))]
            stem = np.unique(stems[at[i] : at[i + 1]][long[at[i] : at[i + 1]]]) + _WORDS
            out.append(np.concatenate([distinct, stem, [2 * _WORDS + 16 * k + s for k, s in enumerate(steps)]]).astype(np.int64))
        yield lo, hi, out


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, found in features(batch.column("text")):
            columns = [pa.array([f.astype(np.int32).tobytes() for f in found], pa.binary())] + [batch.column(c).slice(lo, hi - lo) for c in CLASSES]
            yield pa.record_batch(columns, names=["found", *CLASSES])


def _scores(batches: Iterator[pa.RecordBatch], weights: np.ndarray, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, found in features(batch.column("text")):
            sums = np.array([weights[f].sum(0) for f in found]).reshape(-1, 2)
            columns = [batch.column(c).slice(lo, hi - lo) for c in keep] + [pa.array(sums[:, 0]), pa.array(sums[:, 1])]
            yield pa.record_batch(columns, names=[*keep, *(f"score_{c}" for c in CLASSES)])


def _scored(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    fields = [docs.schema[c] for c in keep] + [T.StructField(f"score_{c}", T.DoubleType()) for c in CLASSES]
    return docs.select(*keep, "text").mapInArrow(lambda it: _scores(it, weights, keep), T.StructType(fields))


def fit(found: list[np.ndarray], label: np.ndarray, least_z: float = 4.0, ridge: float = 0.3, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on the presence of features, with a ridge, by gradient steps that are scaled
    for each feature. Words whose log-odds ratio is under least_z standard errors have no weight."""
    weights, rate = np.zeros(FEATURES), (label.sum() + 1) / (len(label) + 2)
    intercept = float(np.log(rate / (1 - rate)))
    if len(label) == 0 or label.min() == label.max():
        return weights, intercept
    at, sizes = np.concatenate(found), np.array([len(f) for f in found])
    starts = np.cumsum(sizes) - sizes
    ones = np.bincount(at, np.repeat(label, sizes), FEATURES)
    zeros = np.bincount(at, minlength=FEATURES) - ones
    table = [x + 0.5 for x in (ones, zeros, label.sum() - ones, len(label) - label.sum() - zeros)]
    ratio = np.log(table[0]) + np.log(table[3]) - np.log(table[1]) - np.log(table[2])
    used = np.abs(ratio) >= least_z * np.sqrt(sum(1 / x for x in table))
    used[2 * _WORDS :] = True
    squares = np.full(FEATURES, 1e-8)
    for _ in range(rounds):
        z = np.add.reduceat(weights[at], starts) + intercept
        error = label - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        gradient = (np.bincount(at, np.repeat(error, sizes), FEATURES) - ridge * weights) * used
        squares += gradient**2
        weights += 0.3 * gradient / np.sqrt(squares)
        intercept += 0.5 * float(error.mean())
    return weights, intercept


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, quality, toxic of the documents with a label of either class, one row each. Of conflicting labels the majority counts, and of as many on either side the worse
    one: quality 0, toxic 1. Rows without a doc_id are left out."""
    share = lambda c: F.avg(F.col(c).cast("double"))
    return labels.filter("doc_id is not null").groupBy("doc_id").agg((share("quality") > 0.5).cast("int").alias("quality"), (share("toxic") >= 0.5).cast("int").alias("toxic"))


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """doc_id, text, quality, toxic of about most_rows labelled documents, or of so many that their texts have about most_bytes (those with the lowest
    hash of their id); one row for each doc_id, of different texts the first in order."""
    labels = known_labels(labels).dropna()
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    rows = min(most_rows, int(most_bytes * size["n"] / max(1, size["bytes"] or 1)))
    total = labels.count()
    if total > rows:
        labels = labels.filter(hash60(F.col("doc_id")) < int(2**60 * rows / total))
    found = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")  # bounded by most_rows
    return found.groupBy("doc_id", *CLASSES).agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 10_000, most_bytes: int = 256_000_000) -> tuple[np.ndarray, list[float]]:
    """Weights of the features and intercepts for either class, from a sample of labelled documents whose features the driver gets (see
    labelled_sample; the distinct features of a document, at most 2 MB, take about as many bytes as its text)."""
    sample = labelled_sample(docs, labels, most_rows, most_bytes).select("doc_id", "text", *CLASSES)
    rows = sample.mapInArrow(_collected, "found binary, quality int, toxic int").toPandas()
    if rows.empty:  # nothing is known against any document
        return np.zeros((FEATURES, 2)), [5.0, -5.0]
    found = [np.frombuffer(x, np.int32) for x in rows["found"]]
    fits = [fit(found, rows[c].to_numpy(float)) for c in CLASSES]
    return np.stack([w for w, _ in fits], 1), [i for _, i in fits]


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, name: str, rate: Column, up: Column) -> float:
    """Pseudo-documents of the level above: from the spread of the sites' rates beyond that of chance (method of moments)."""
    spread = F.sum(F.col("n") * (rate - up) * (rate - up)) / F.sum("n")
    chance = F.sum(up * (1 - up)) / F.sum("n")
    r = sites.agg(spread.alias("v"), chance.alias("c"), (F.sum(F.col("n") * up * (1 - up)) / F.sum("n")).alias("m")).first()
    if r["v"] is None:
        return 1.0
    between = max(r["v"] - r["c"], 1e-9)
    return float(min(1e5, max(1.0, r["m"] / between - 1)))


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column, most_rows: int = 10_000, use_labels: bool = True, most_toxic: float = 0.3) -> DataFrame:
    """One row per document: doc_id, host, path, and for quality and toxic: evidence (a probability), site (the path's posterior for this document)
    and p (the document's); kept: p_quality >= 0.5 and p_toxic < most_toxic, under a half as a toxic document that stays costs more than a clean one that goes.

    Null texts count as empty; a null host or path is a site of its own, the one of an empty name; repeated rows are rows of their own, and their label counts
    for each. Texts of any length are taken whole; other columns of docs are not read unless host or path do. Without labels every
    document is kept, and no documents give no rows. The regression is fitted on labels of the sampled documents, so for these only the site
    levels are without their own label. use_labels False: the site levels see the evidence only.
    """
    weights, intercepts = train(docs, labels, most_rows)
    sited = docs.select("doc_id", "text", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rows = _scored(sited, weights, ["doc_id", "host", "path"])
    chance = lambda c, i: 1 / (1 + F.exp(-(F.lit(i) + F.col(f"score_{c}"))))
    rows = rows.select("doc_id", "host", "path", *[chance(c, i).alias(f"evidence_{c}") for c, i in zip(CLASSES, intercepts, strict=True)])
    known = known_labels(labels)
    return posteriors(stored(rows.join(known, "doc_id", "left") if use_labels else rows.withColumns({c: F.lit(None).cast("int") for c in CLASSES}), "evidence"), most_toxic)


def posteriors(rows: DataFrame, most_toxic: float = 0.3) -> DataFrame:
    """The site levels, of rows with doc_id, host, path, evidence_* and the labels quality and toxic (null where unknown); see judged."""
    sums = [F.sum(F.coalesce(F.col(c).cast("double"), F.col(f"evidence_{c}"))).alias(c) for c in CLASSES]
    paths = stored(rows.groupBy("host", "path").agg(F.count("*").alias("n"), *sums), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in CLASSES]), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in CLASSES]).first()
    top = {c: (whole[c] or 0) / whole["n"] if whole["n"] else 0.5 for c in CLASSES}
    host_rows, path_rows = hosts, paths
    for c in CLASSES:
        k = _strength(hosts, c, F.col(c) / F.col("n"), F.lit(top[c]))
        host_rows = host_rows.withColumn(f"host_{c}", (F.col(c) + k * top[c]) / (F.col("n") + k))
    path_rows = stored(path_rows.join(host_rows.select("host", *[f"host_{c}" for c in CLASSES]), "host"), "path-posteriors")
    strengths = {c: _strength(path_rows, c, F.col(c) / F.col("n"), F.col(f"host_{c}")) for c in CLASSES}
    sites = path_rows.select("host", "path", F.col("n").alias("site_n"), *[F.col(c).alias(f"sum_{c}") for c in CLASSES], *[f"host_{c}" for c in CLASSES])
    out = rows.join(sites, ["host", "path"])
    for c, k in strengths.items():
        own = F.coalesce(F.col(c).cast("double") - F.col(f"evidence_{c}"), F.lit(0.0))
        out = out.withColumn(f"site_{c}", (F.col(f"sum_{c}") - own + k * F.col(f"host_{c}")) / (F.col("site_n") + k))
        z = _logit(F.col(f"evidence_{c}")) + _logit(F.col(f"site_{c}")) - _logit(F.lit(top[c]))
        out = out.withColumn(f"p_{c}", 1 / (1 + F.exp(-z)))
    columns = [f"{x}_{c}" for x in ("evidence", "site", "p") for c in CLASSES]
    return out.select("host", "path", "doc_id", *columns).withColumn("kept", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < most_toxic))
