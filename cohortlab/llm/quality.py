"""Quality rules with risk-controlled thresholds (operator 7).

Each rule rejects documents whose feature exceeds a cutoff. Cutoffs are chosen
per stratum (language) on the labelled documents, jointly for all rules: one fixed
sequence of steps, each lowering one rule's cutoff by a bin, is tested from
rejecting nothing downwards. A step is admissible if the exact (Clopper-Pearson)
upper bound on the rate at which all rules together reject good documents is at
most ``alpha``, at level ``delta`` divided by the number of strata that have enough
good documents to reject anything. Testing stops at the first failure (fixed-
sequence testing), so the steps themselves need no further correction. With
probability 1 - ``delta`` every stratum then loses at most ``alpha`` of its good
documents. A stratum with too few labelled good documents (``least_good``) gets no
cutoff: nothing is rejected there by the rules.

The sequence must not depend on the good documents it is tested on. It is drawn
from the others, those labelled bad and those without a label: first the cutoffs
that take a larger share of the bad than of the unlabelled, then the cutoffs of all
rules by the share of the unlabelled that lies above them.

Features are counted in numpy over whole slices of documents. The labelled
documents are reduced to histograms (stratum, rule, bin), so what reaches the
driver is bounded by strata x rules x bins; all labels are used. A good document
counts at the first step that rejects it, so the counts add up to joint rejections.

Defined cases: a null text has no words; a null or unseen stratum has its own
cutoffs or none; labels without a document are ignored, repeated labels of one
id count once (the lowest quality); an empty table gives an empty result; a null
id has no label. Input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm.common import binary_list, mix64, slices, table, without, written

SYMBOLS = b"#*$%&|<>"
RUN = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words", "n_marks")
# Rules: feature in [0, 1] as a ratio of two counts. Bins of 1 %.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
    "upper_words": ("n_upper_words", "n_words"),
    "marks": ("n_marks", "n_words"),
}
BINS = 100

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends[1:]] - total[ends[:-1]]


def repeated_words(codes: np.ndarray, doc: np.ndarray, n_docs: int, run: int = RUN) -> np.ndarray:
    """Per document: words that lie in a window of ``run`` words found again in it."""
    n = len(codes) - run + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    # adjacent windows of one document; equal hashes are compared word by word
    at = np.flatnonzero(doc[:n] == doc[run - 1:])
    h = mix64(doc[at].astype(np.uint64) + np.uint64(0x51))
    for j in range(run):
        h = mix64(h ^ (codes[at + j].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)))
    order = np.argsort(h, kind="stable")
    s = at[order]
    same = h[order][1:] == h[order][:-1]
    pairs = np.flatnonzero(same)
    if len(pairs):
        a, b = s[pairs], s[pairs + 1]
        ok = doc[a] == doc[b]
        for j in range(run):
            ok &= codes[a + j] == codes[b + j]
        a, b = a[ok], b[ok]
        step = np.zeros(len(codes) + run + 1, np.int64)
        starts = np.unique(np.concatenate([a, b]))
        np.add.at(step, starts, 1)
        np.add.at(step, starts + run, -1)
        covered = np.cumsum(step)[:len(codes)] > 0
        return np.bincount(doc[covered], minlength=n_docs)
    return np.zeros(n_docs, np.int64)


def count_features(texts: list[bytes]) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    n = len(texts)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    space = _SPACE[raw]
    chars = (raw & 0xC0) != 0x80
    out = {"word_chars": _sums(chars & ~space, ends), "n_symbols": _sums(_SYMBOL[raw], ends)}
    words = [t.split() for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, n)
    out["n_words"] = n_words
    known: dict[bytes, int] = {}
    flat = [w for ws in words for w in ws]
    code = known.setdefault
    codes = np.fromiter((code(w, len(known)) for w in flat), np.int64, len(flat))
    doc = np.repeat(np.arange(n), n_words)
    out["n_repeat_words"] = repeated_words(codes, doc, n)
    upper = np.fromiter((w.isupper() and len(w) > 1 for w in known), bool, len(known))
    marks = np.fromiter((w[-1:] in b"!?" for w in known), bool, len(known))
    for name, flag in (("n_upper_words", upper), ("n_marks", marks)):
        out[name] = np.bincount(doc[flag[codes]], minlength=n) if len(flat) else np.zeros(n, np.int64)
    lines = np.zeros(n, np.int64)
    dup = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        own = [x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        lines[i] = len(own)
        dup[i] = len(own) - len(set(own))
    out["n_lines"], out["n_dup_lines"] = lines, dup
    return out


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (its columns in ``row``) with COUNTS."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = count_features(binary_list(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(counts[c], pa.int64()) for c in COUNTS], names=["row", *COUNTS])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed():
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def rule_bin(rule: str):
    """The rule's feature as a bin 0 .. BINS; bin b holds ratios in ((b-1)/BINS, b/BINS]."""
    a, b = RULES[rule]
    ratio = F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return F.least(F.ceil(ratio * BINS), F.lit(BINS)).cast("int")


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the largest rate at which k or fewer of n has chance ``level``."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def at_most_k(p: float) -> float:
        lp, lq = math.log(p), math.log1p(-p)
        return math.fsum(math.exp(c + i * lp + (n - i) * lq) for i, c in enumerate(logs))

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if mid <= 0 or at_most_k(mid) > level:
            low = mid
        else:
            high = mid
        if high - low < 1e-9:
            break
    return high


def least_good(alpha: float, level: float) -> int:
    """The fewest good documents with which a cutoff that rejects none of them is admissible."""
    return math.ceil(math.log(level) / math.log1p(-alpha))


def most_rejected(n: int, alpha: float, level: float) -> int:
    """The largest k whose ``upper_bound`` is at most ``alpha``; -1 if there is none."""
    chance, lp, lq = 0.0, math.log(alpha), math.log1p(-alpha)
    for k in range(n):
        chance += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * lp + (n - k) * lq)
        if chance > level:
            return k - 1
    return n - 1


def sequence(bad: dict[str, np.ndarray], unlabelled: dict[str, np.ndarray], lift: float = 2.0, least: int = 5) -> list[tuple[str, int]]:
    """All steps (rule, cut) in the order of testing; each lowers the rule's cutoff to ``cut``.

    ``bad``, ``unlabelled``: rule -> documents by bin. First come, by falling lift,
    the runs of a rule's steps that take more than ``lift`` times the share of the
    bad documents that they take of the unlabelled, and ``least`` bad documents.
    """
    steps, reached = [], dict.fromkeys(RULES, BINS)
    while True:
        best = None
        for rule in RULES:
            b, u = bad[rule], unlabelled[rule]
            taken_b = taken_u = 0
            for cut in range(reached[rule] - 1, -1, -1):
                taken_b, taken_u = taken_b + int(b[cut + 1]), taken_u + int(u[cut + 1])
                if taken_b < least:
                    continue
                gain = (taken_b / int(b.sum())) / ((taken_u + 1) / (int(u.sum()) + 1))
                if gain > lift and (best is None or (gain, reached[rule] - cut) > best[:2]):
                    best = gain, reached[rule] - cut, rule, cut
        if best is None:
            break
        rule, cut = best[2:]
        steps += [(rule, c) for c in range(reached[rule] - 1, cut - 1, -1)]
        reached[rule] = cut
    # the rest by the share of the unlabelled documents above the cut: the rules spend alpha evenly
    above = {r: np.cumsum(unlabelled[r][::-1])[::-1] for r in RULES}
    rest = [(int(above[r][cut + 1]), -cut, r) for r in RULES for cut in range(reached[r])]
    return steps + [(r, -cut) for _, cut, r in sorted(rest, key=lambda x: x[:2])]


def even_sequence() -> list[tuple[str, int]]:
    none = {rule: np.zeros(BINS + 1, np.int64) for rule in RULES}
    return sequence(none, none)


def choose_cutoffs(histogram: list[tuple[str | None, str, int, int]], alpha: float, delta: float,
                   steps: list[tuple[str, int]] | None = None) -> dict[tuple[str | None, str], int]:
    """(stratum, rule) -> largest bin that is still kept; rules without one reject nothing.

    ``histogram``: (stratum, rule, bin, good documents), every document once in
    each rule. Rejections are added over the rules: exact if a document lies above
    bin 0 only in the rule that rejects it first, and never too few.
    """
    good: dict[str | None, dict[str, np.ndarray]] = {}
    for stratum, rule, b, n in histogram:
        good.setdefault(stratum, {r: np.zeros(BINS + 1, np.int64) for r in RULES})[rule][b] += n
    totals = {s: max(int(x.sum()) for x in by.values()) for s, by in good.items()}
    # which strata are tested depends on their sizes alone, not on what is rejected
    largest = sorted(totals, key=lambda s: (-totals[s], str(s)))
    while largest and totals[largest[-1]] < least_good(alpha, delta / len(largest)):
        largest.pop()
    cutoffs = {}
    for stratum in largest:
        most, above = most_rejected(totals[stratum], alpha, delta / len(largest)), 0
        for rule, cut in steps or even_sequence():
            above += int(good[stratum][rule][cut + 1])
            if above > most:
                break
            cutoffs[stratum, rule] = cut
    return cutoffs


def calibrate(counted: DataFrame, labels: DataFrame, id_col: str, stratum: str, alpha: float, delta: float
              ) -> dict[tuple[str | None, str], int]:
    """Cutoffs from the documents that pass the base rules.

    ``counted``: id, stratum, COUNTS. One shuffle of narrow rows on the id, whose
    bins are stored for two histograms: of the documents that are not good, which
    give the sequence, then of the good ones.
    """
    known = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.min("quality").alias("quality"))
    named = counted.where(F.col(id_col).isNotNull() & ~base_failed()).select(
        F.col(id_col), F.col(stratum).alias("stratum"), *[rule_bin(r).alias(r) for r in RULES])
    marked = written(named.join(known, F.col(id_col) == F.col("label_id"), "left").select("stratum", "quality", *RULES), "bins")
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bin")) for r in RULES])).alias("x")
    others = (marked.where(F.col("quality").isNull() | (F.col("quality") != 1)).select(F.col("quality").isNotNull().alias("bad"), bins)
              .groupBy("bad", "x.rule", "x.bin").count().collect())
    counts = {flag: {r: np.zeros(BINS + 1, np.int64) for r in RULES} for flag in (True, False)}
    for r in others:
        counts[r["bad"]][r["rule"]][r["bin"]] += r["count"]
    steps = sequence(counts[True], counts[False])
    # the first step that rejects a bin of a rule: the one that lowers the cutoff below it
    step_of = {rule: [len(steps)] * (BINS + 1) for rule in RULES}
    for at, (rule, cut) in enumerate(steps):
        step_of[rule][cut + 1] = at
    first = F.least(*[F.element_at(F.array(*[F.lit(x) for x in step_of[r]]), F.col(r) + 1) for r in RULES])
    rows = marked.where(F.col("quality") == 1).groupBy("stratum", first.alias("step")).count().collect()
    totals: dict[str | None, int] = {}
    histogram = []
    for r in rows:
        totals[r["stratum"]] = totals.get(r["stratum"], 0) + r["count"]
        if r["step"] < len(steps):
            rule, cut = steps[r["step"]]
            histogram.append((r["stratum"], rule, cut + 1, r["count"]))
    for s, n in totals.items():  # in its other rules a document lies in bin 0
        for rule in RULES:
            histogram.append((s, rule, 0, n - sum(h[3] for h in histogram if h[:2] == (s, rule) and h[2])))
    return choose_cutoffs(histogram, alpha, delta, steps)


def verdict(cutoffs: dict[tuple[str | None, str], int], stratum: str):
    """True where no rule rejects the document."""
    rejected = F.lit(False)
    for (s, rule), cut in sorted(cutoffs.items(), key=str):
        rejected = rejected | (F.col(stratum).eqNullSafe(F.lit(s)) & (rule_bin(rule) > cut))
    return ~base_failed() & ~rejected


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
           alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """id, stratum, COUNTS, base_failed, kept of every document (without its other columns)."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    counted = written(features(narrow).select("row.id", "row.stratum", *COUNTS), "features")
    cutoffs = calibrate(counted, labels.withColumnRenamed(id_col, "id"), "id", "stratum", alpha, delta)
    return counted.select("id", "stratum", *COUNTS, base_failed().alias("base_failed"), verdict(cutoffs, "stratum").alias("kept"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                   stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The documents that every rule keeps, with their own columns.

    Cutoffs need one pass; the second pass counts again and filters in place, so
    no text is shuffled.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    counted = features(narrow).select("row.id", "row.stratum", *COUNTS)
    cutoffs = calibrate(counted, labels.withColumnRenamed(id_col, "id"), "id", "stratum", alpha, delta)
    again = features(docs).withColumn("stratum", F.col(f"row.`{stratum}`").cast("string"))
    return again.where(verdict(cutoffs, "stratum")).select("row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = judged(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")
