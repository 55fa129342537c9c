"""Log-bilinear language model trained with noise-contrastive estimation (operator 3).

Tokens: words of the lower-cased text and one end. Every token has a class: the
end, each of the ``frequent`` most frequent words, or, for all others, one of
``buckets`` suffix classes. The model's probability of a token is

    P(class | two previous classes) * P(word | class),

the second factor a smoothed relative frequency inside the class, with one slot
for unknown words. Both factors are normalised, so a text's score is a true
log-probability over all words. The number of classes is a parameter; the word
statistics behind them cover every training document.

The log-bilinear part predicts a class vector q = Q[a] A + Q[b] B from the two
previous classes; a class scores q . R[class] + bias. Training is in numpy inside
Spark tasks: minibatches of consecutive tokens against shared noise classes. Each
training block is used once, in one of ``rounds`` rounds, and after each round Spark
averages the tasks' parameters, weighted by tokens. Scoring multiplies each batch's
distinct contexts with all classes at once, which gives the normalisers.

Flow: coded blocks (``blocks.py``) -> counts of distinct words -> class, count and
inner probability back to the blocks -> class sequences per document, written once
-> training rounds -> scores, without another shuffle.

Defined cases: a null or empty text is one end token; a null id counts as the empty
text in the split, which holds it out; repeated ids are separate documents; with no
training documents every count is 0 and the model is uniform over classes; an empty
table gives an empty result; texts are whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.blocks import coded_blocks, dictionary, pack, unpack
from cohortlab.llm.common import table, written

SMOOTH = 0.1


@dataclass
class Shape:
    """Sizes of the model; all bounded parameters, whatever the corpus."""

    frequent: int = 512
    buckets: int = 256
    dimension: int = 16
    noise: int = 32
    batch: int = 1024
    rounds: int = 4
    rate: float = 0.3

    @property
    def classes(self) -> int:
        return 1 + self.frequent + self.buckets


class Model:
    """Parameters as one flat vector, so that Spark can average them.

    Single precision while learning; averages are formed in double precision.
    """

    def __init__(self, shape: Shape, unigram: np.ndarray) -> None:
        c, d = shape.classes, shape.dimension
        rng = np.random.default_rng(11)
        self.shape, self.log_noise = shape, np.log(unigram)
        self.parts = {
            "target": rng.normal(0, 0.05, (c, d)), "context": rng.normal(0, 0.3, (c + 1, d)),  # last: before the text
            "near": np.eye(d), "far": np.eye(d) * 0.5, "bias": self.log_noise}
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}
        self.seen = {k: np.full(v.shape, 0.02, np.float32) for k, v in self.parts.items()}
        self.noise_p = np.exp(self.log_noise)
        self.log_noise = (self.log_noise + np.log(shape.noise)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for g in (self.parts, self.seen) for x in g.values()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for group in (self.parts, self.seen):
            for k, v in group.items():
                group[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size

    def predict(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        p = self.parts
        return p["context"][a] @ p["near"] + p["context"][b] @ p["far"]

    def _step(self, name: str, grad: np.ndarray) -> None:
        self.seen[name] += grad * grad
        self.parts[name] -= self.shape.rate * grad / np.sqrt(self.seen[name])

    def learn(self, a: np.ndarray, b: np.ndarray, w: np.ndarray, rng: np.random.Generator) -> None:
        """One minibatch of noise-contrastive estimation."""
        p, k = self.parts, self.shape.noise
        noise = rng.choice(len(self.noise_p), k, p=self.noise_p)
        qa, qb = p["context"][a], p["context"][b]
        q = qa @ p["near"] + qb @ p["far"]
        real = (q * p["target"][w]).sum(axis=1) + p["bias"][w] - self.log_noise[w]
        fake = q @ p["target"][noise].T + p["bias"][noise] - self.log_noise[noise]
        each = np.float32(1 / len(w))
        g_real = -each / (1 + np.exp(np.clip(real, -30, 30)))
        g_fake = each / (1 + np.exp(np.clip(-fake, -30, 30)))
        dq = g_real[:, None] * p["target"][w] + g_fake @ p["target"][noise]
        target = _add_rows(w, g_real[:, None] * q, len(p["target"]))
        np.add.at(target, noise, g_fake.T @ q)
        bias = np.bincount(w, g_real, minlength=len(p["bias"])).astype(np.float32)
        np.add.at(bias, noise, g_fake.sum(axis=0))
        context = _add_rows(np.concatenate([a, b]), np.concatenate([dq @ p["near"].T, dq @ p["far"].T]), len(p["context"]))
        near, far = qa.T @ dq, qb.T @ dq
        for name, grad in (("target", target), ("bias", bias), ("context", context), ("near", near), ("far", far)):
            self._step(name, grad)

    def log10_classes(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Normalised log10 P(class | context) of each token."""
        width = self.shape.classes + 1
        pairs, where = np.unique(a.astype(np.int64) * width + b, return_inverse=True)
        q = self.predict(pairs // width, pairs % width)
        norm = np.empty(len(pairs))
        # the normalisers' exponentials in single precision, their sums in double
        target, bias = self.parts["target"].T, self.parts["bias"]
        for s in range(0, len(pairs), 2048):
            x = q[s:s + 2048] @ target
            x += bias
            top = x.max(axis=1, keepdims=True)
            x -= top
            norm[s:s + 2048] = top[:, 0] + np.log(np.exp(x, out=x).sum(axis=1, dtype=np.float64))
        out = np.empty(len(w))
        for s in range(0, len(w), 1 << 17):  # bounds the gathered vectors
            e = slice(s, s + (1 << 17))
            out[e] = (q[where[e]] * self.parts["target"][w[e]]).sum(axis=1, dtype=np.float64) + self.parts["bias"][w[e]] - norm[where[e]]
        return out / np.log(10)


def _add_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by index: sorted segments instead of scattered writes."""
    order = np.argsort(index, kind="stable")
    values, starts = np.unique(index[order], return_index=True)
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[values] = np.add.reduceat(rows[order], starts, axis=0)
    return out


def contexts(seqs: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, the one before, token) of all tokens; ``start`` stands before a text."""
    w = np.concatenate(seqs).astype(np.int64)
    first = np.cumsum([0] + [len(s) for s in seqs[:-1]])
    a, b = np.empty_like(w), np.empty_like(w)
    a[1:], b[2:] = w[:-1], w[:-2]
    a[first] = start
    b[first] = start
    second = first[[len(s) > 1 for s in seqs]] + 1
    b[second] = start
    return a, b, w


def word_table(blocks: DataFrame, shape: Shape, train_docs: int) -> tuple[DataFrame, int, int, np.ndarray]:
    """(word, c, class, inner) of all words, N, V, and the classes' unigram probabilities."""
    counts = written(dictionary(blocks).groupBy("word").agg(F.sum("n").alias("c")), "counts")
    top = counts.where(F.col("c") > 0).orderBy(F.desc("c"), "word").limit(shape.frequent)
    listed = [(bytes(r["word"]), i + 1) for i, r in enumerate(top.collect())]  # at most ``frequent`` words
    ranks = counts.sparkSession.createDataFrame(listed, "word binary, own int")
    bucket = (F.pmod(F.xxhash64(F.substring("word", -3, 3)), F.lit(shape.buckets)) + 1 + shape.frequent).cast("int")
    classed = counts.join(F.broadcast(ranks), "word", "left").select("word", "c", F.coalesce("own", bucket).alias("class"))
    stats = classed.groupBy("class").agg(F.sum("c").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v"))
    rows = stats.collect()  # a row per class
    n, v = np.zeros(shape.classes), np.zeros(shape.classes)
    n[0], v[0] = train_docs, int(train_docs > 0)
    for r in rows:
        n[r["class"]], v[r["class"]] = r["n"], r["v"]
    total, distinct = int(n.sum()), int(v.sum())
    unigram = (n + SMOOTH) / (n + SMOOTH).sum()
    sizes = stats.select(F.col("class"), F.col("n").alias("n_class"), F.col("v").alias("v_class"))
    inner = F.when(F.col("class") <= shape.frequent, F.lit(0.0)).otherwise(
        F.log10((F.col("c") + SMOOTH) / (F.col("n_class") + SMOOTH * (F.col("v_class") + 1))))
    full = classed.join(F.broadcast(sizes), "class").select("word", "c", "class", inner.alias("inner"))
    return full, total, distinct, unigram


def _classify(kind: pa.DataType, total: int, distinct: int, train_docs: int):
    """Blocks and their words' values -> documents with class sequences."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("id", "flag", "n_tokens", "n_known", "base", "inner", "seq")}
        if left.num_rows:
            index = right.column("idx").to_numpy()
            words = left.column("n_words")[0].as_py()
            if len(index) != words:
                raise RuntimeError("a block's words are not complete")
            c, klass, inner = np.empty(words), np.empty(words, np.int64), np.empty(words)
            c[index] = right.column("c").to_numpy()
            klass[index] = right.column("class").to_numpy()
            inner[index] = right.column("inner").to_numpy()
            under = total + SMOOTH * (distinct + 1)
            base = np.log10((c + SMOOTH) / under)
            end = np.log10((train_docs + SMOOTH) / under)
            codes, begin = unpack(left.column("codes")[0].as_py()), 0
            for key, flag, stop in zip(left.column("ids")[0].as_py(), left.column("flags")[0].as_py(), left.column("ends")[0].as_py()):
                own = codes[begin:stop]
                out["id"].append(key)
                out["flag"].append(flag)
                out["n_tokens"].append(len(own) + 1)
                out["n_known"].append(int((c[own] > 0).sum()) + int(train_docs > 0))
                out["base"].append(float(base[own].sum() + end))
                out["inner"].append(float(inner[own].sum()))
                out["seq"].append(pack(np.append(klass[own], 0)))
                begin = stop
        kinds = (kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(out.values(), kinds)], names=list(out))

    return run


def _train(shared, shape: Shape, unigram: np.ndarray, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shape, unigram)
        model.load(shared.value)
        rng = np.random.default_rng(turn)
        waiting: list[np.ndarray] = []
        held = seen = 0

        def learn() -> None:
            a, b, w = contexts(waiting, shape.classes)
            order = rng.permutation(len(w))
            for s in range(0, len(w), shape.batch):
                at = order[s:s + shape.batch]
                model.learn(a[at], b[at], w[at], rng)

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                waiting.append(unpack(blob))
                held += len(waiting[-1])
                if held >= 1 << 19:
                    learn()
                    seen, waiting, held = seen + held, [], 0
        if held:
            learn()
            seen += held
        if seen:
            flat = model.flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                names=["i", "x", "w"])

    return run


def train(docs: DataFrame, shape: Shape, unigram: np.ndarray) -> Model:
    """``rounds`` rounds over the class sequences of flagged documents."""
    spark = docs.sparkSession
    model = Model(shape, unigram)
    for turn in range(shape.rounds):
        shared = spark.sparkContext.broadcast(model.flat())
        part = docs.where(F.col("flag") & (F.pmod(F.xxhash64("id", F.lit("round")), F.lit(shape.rounds)) == turn)).select("seq")
        mean = (part.mapInArrow(_train(shared, shape, unigram, turn), "i int, x double, w double")
                .groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).toArrow())  # a row per parameter
        if mean.num_rows:
            flat = np.empty(mean.num_rows)
            flat[mean.column("i").to_numpy()] = mean.column("x").to_numpy()
            model.load(flat)
    return model


def score_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shape: Shape | None = None) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    spark, shape = docs.sparkSession, shape or Shape()
    remainder = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 10
    named = docs.select(F.col(id_col).alias("id"), (remainder != 0).alias("flag"), F.col(text).alias("text"))
    blocks = coded_blocks(named, lambda blob: blob.lower().split())
    train_docs = blocks.select(F.sum(F.expr("size(filter(flags, f -> f))"))).first()[0] or 0
    words, total, distinct, unigram = word_table(blocks, shape, int(train_docs))
    back = dictionary(blocks).select("block", "idx", "word").join(words, "word").select("block", "idx", "c", "class", "inner")
    kind = named.schema["id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    left = blocks.select("block", "ids", "flags", "ends", "codes", F.size("words").alias("n_words"))
    right = back.withColumnRenamed("block", "word_block")
    classed = written(left.groupBy("block").cogroup(right.groupBy("word_block")).applyInArrow(
        _classify(arrow, total, distinct, int(train_docs)),
        f"id {kind}, flag boolean, n_tokens long, n_known long, base double, inner double, seq binary"), "classes")
    model = train(classed, shape, unigram)
    shared = spark.sparkContext.broadcast(model.flat())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shape, unigram)
        own.load(shared.value)
        for batch in batches:
            scores, waiting, held = [], [], 0

            def add() -> None:
                lp = own.log10_classes(*contexts(waiting, shape.classes))
                scores.extend(np.add.reduceat(lp, np.cumsum([0] + [len(s) for s in waiting[:-1]])).tolist())

            for blob in batch.column(6).to_pylist():
                waiting.append(unpack(blob))
                held += len(waiting[-1])
                if held >= 1 << 21:
                    add()
                    waiting, held = [], 0
            if waiting:
                add()
            score = np.asarray(scores) + batch.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(score)],
                                             names=["id", "flag", "n_tokens", "n_known", "base", "score"])

    scored = classed.mapInArrow(run, f"id {kind}, flag boolean, n_tokens long, n_known long, base double, score double")
    return scored.select("id", (~F.col("flag")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs).withColumnRenamed("id", "doc_id")
