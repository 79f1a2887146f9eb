"""Operator 4: quality rules, a base check and a learned decision list.

Tasks count statistics of every whole text. The decision list is learned by sequential covering from
the statistics of labelled documents: a rule is a conjunction of thresholds, grown condition by
condition on two thirds of the rows by information gain, pruned on the other third, and kept if it is
precise enough there; the rows it covers are set aside and the next rule is sought among the rest. The
list is emitted as ordered Spark conditional expressions over the statistics, so judging is a
projection. Rejecting wrongly costs good text, so rules must be precise on rows they were not grown on.

The learner sees at most ``MAX_LABELLED`` labelled rows, chosen by the hash of their doc_id; the
statistics and the judgement cover all rows.

Defined results: null or empty text: all counts zero, base failed. Null doc_id: judged like any other.
Repeated rows: each by itself. No labels, or one kind only: an empty list, so the base check decides.
Empty table: no rows. In ``judged`` the documents' own columns keep their names; the statistics stand in
one struct named by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import BASES, Words, byte_chunks, mix, span_hash

MAX_LABELLED = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MIN_PRECISION, MIN_COVER, MAX_RULES, MAX_CONDITIONS = 0.95, 8, 16, 4
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks",
)
#: What thresholds are put on: name and Spark expression over the counts.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _MARK, _DIGIT = _table(b"#*$%&|<>"), _table(b"!?"), _table(b"0123456789")
_UPPER, _SPACE = _table(bytes(range(65, 91))), _table(b"\t\n\x0b\x0c\r ")
_NEW_CHAR = ~_table(bytes(range(0x80, 0xC0)))


def _repeat_words(w: Words) -> np.ndarray:
    """Words of each text within 3-word windows that stand in it twice or more."""
    n = len(w.start)
    if n < 3:
        return np.zeros(len(w.n), np.int64)
    h = w.hashes()
    at = np.flatnonzero(w.text_of[:-2] == w.text_of[2:])
    grams = span_hash(h, at, at + 3, BASES[1]) ^ mix(w.text_of[at].astype(np.uint64))
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(w.text_of[covered], minlength=len(w.n))


def _dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def count_texts(texts) -> pd.DataFrame:
    """The counts of each text."""
    parts = []
    for _, _, raw in byte_chunks(texts):
        w = Words(raw)
        at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])])
        total = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[w.buf])])[np.minimum(at, len(w.buf))])  # noqa: E731, B023
        lines = np.array([_dup_lines(t) for t in raw], np.int64).reshape(-1, 2)
        parts.append(pd.DataFrame({
            "n_words": w.n, "word_chars": total(_NEW_CHAR & ~_SPACE), "n_symbols": total(_SYMBOL),
            "n_dup_lines": lines[:, 1], "n_repeat_words": _repeat_words(w), "n_lines": lines[:, 0],
            "n_upper": total(_UPPER), "n_digits": total(_DIGIT), "n_marks": total(_MARK),
        }))
    return pd.concat(parts, ignore_index=True).astype(np.int64) if parts else pd.DataFrame(columns=COUNTS, dtype=np.int64)


def statistics(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the counts of each row; with ``carry`` also the text, as ``text``."""
    names = ["doc_id", "text"] if carry else ["doc_id"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield pd.concat([frame[names].reset_index(drop=True), count_texts(frame["text"])], axis=1)

    kinds = "doc_id long, " + "text string, " * carry + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, kinds)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold!r}D"

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.feature] > self.threshold) == self.above


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> Condition | None:
    """The condition with the largest gain p * (log share after - log share before)."""
    p0, n0 = int(bad[inside].sum()), int(inside.sum())
    best, found = 1e-9, None
    before = np.log2(max(p0, 1e-9) / n0)
    for name, values in x.items():
        order = np.argsort(values[inside], kind="stable")
        v, b = values[inside][order], np.cumsum(bad[inside][order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below_n, below_p = cut + 1, b[cut]
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((p > 0) & (n >= MIN_COVER), p * (np.log2(p / n) - before), -1)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = gain[k], Condition(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return found


def learn(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """An ordered list of rules that each reject; what none covers is kept."""
    n = len(bad)
    grow = np.random.default_rng(seed).random(n) < 2 / 3
    left, rules = np.ones(n, bool), []
    while len(rules) < MAX_RULES and (left & grow & bad).sum() >= MIN_COVER:
        rule: Rule = ()
        inside = left & grow
        while len(rule) < MAX_CONDITIONS and bad[inside].mean() < 1:
            found = _best_condition(x, bad, inside)
            if found is None:
                break
            rule, inside = (*rule, found), inside & found.holds(x)

        def worth(r: Rule) -> float:
            held = _covers(r, x, n) & left & ~grow  # noqa: B023
            p = int(bad[held].sum())
            return (p + 1) / (int(held.sum()) + 2)

        pruned = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth, default=())
        covered = _covers(pruned, x, n) & left
        share = bad[covered].mean() if covered.any() else 0
        if not pruned or worth(pruned) < MIN_PRECISION or share < MIN_PRECISION:
            break
        rules.append(pruned)
        left &= ~covered
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[Rule]:
    """The decision list from ``labels(doc_id, quality)``; rows that fail the base check take no part."""
    some = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long"), "quality")
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(some), "doc_id")
    kinds = rows.select("doc_id", "quality").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    stats = statistics(rows).where(~base_failed()).join(kinds, "doc_id")
    got = stats.select("quality", *(F.expr(e).cast("double").alias(k) for k, e in FEATURES.items())).toPandas()
    got = got.sort_values(list(got.columns), ignore_index=True)  # whatever order the rows came in
    return learn({k: got[k].to_numpy(float) for k in FEATURES}, got["quality"].to_numpy() == 0) if len(got) else []


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, or null: one conditional expression."""
    if not rules:
        return F.lit(None).cast("int")
    cases = " ".join(f"WHEN {' AND '.join(c.sql() for c in r)} THEN {i}" for i, r in enumerate(rules, 1))
    return F.expr(f"CASE {cases} END").cast("int")


def verdicts(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """base_failed, rule (the number of the first rule that rejects) and kept beside the counts."""
    return counted.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base check and the list keep, with the columns of ``docs``."""
    rules, counts = learn_rules(docs, labels), ", ".join(f"{c} long" for c in COUNTS)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("_text"))

    @F.pandas_udf(counts)
    def counted(texts: pd.Series) -> pd.DataFrame:
        return count_texts(texts)

    judged = verdicts(packed.withColumn("c", counted("_text")).select("row", "c.*"), rules)
    return judged.where("kept").select("row.*")
