"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule says good, junk or nothing about a text. How often it says each of a good and of a junk text is estimated by
EM over the counts of all vote patterns of the corpus (at most 3 to the number of rules, whatever the size); a text's
posterior probability of being good follows from its pattern.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_and_bytes, materialize

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_marks", "n_top", "n_lines")
STATS = "doc_id long, h long, " + ", ".join(f"{c} long" for c in COLUMNS)
MIN_WORDS = 50
GOOD, JUNK, NONE = 0, 1, 2


def statistics(body: bytes) -> tuple[int, ...]:
    """The statistics of COLUMNS for one text's UTF-8 bytes."""
    words = body.split()
    n = len(words)
    without = lambda chars: len(body) - len(body.translate(None, chars))
    inside = 0 if body.isascii() else len(body) - len(body.decode("utf-8", "replace"))  # bytes after a character's first
    lines = [x for x in body.split(b"\n") if x.split()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    top = int(np.bincount(ids).max()) if n else 0
    return (n, len(body) - inside - without(SPACES), without(SYMBOLS), len(lines) - len(set(lines)), _repeated(ids, len(number)), without(UPPER), without(LETTERS), body.count(b"!"), top, len(lines))


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words inside any window of three words that the text has twice or more."""
    if len(ids) < 4:
        return 0
    pair = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1].ravel()
    _, which, count = np.unique(pair[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    hit = count[which.ravel()] > 1
    cover = np.zeros(len(ids), bool)
    for k in range(3):
        cover[k : len(hit) + k] |= hit
    return int(cover.sum())


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for b in batches:
            rows = np.array([statistics(x) for x in b.column(1).to_pylist()], dtype=np.int64).reshape(-1, len(COLUMNS))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *(pa.array(rows[:, k]) for k in range(len(COLUMNS)))], ["doc_id", "h", *COLUMNS])

    return id_and_bytes(docs, id_col, text_col).withColumn("h", F.xxhash64("body")).mapInArrow(run, STATS)


def _vote(value: Column, good: Callable[[Column], Column], junk: Callable[[Column], Column]) -> Column:
    return F.when(junk(value), JUNK).when(good(value), GOOD).otherwise(NONE)


def rules() -> dict[str, Column]:
    """The rules' votes: each speaks for and against a text, and abstains between its two thresholds.

    They overlap, and some are weak: many good texts are short or repeat a phrase. What a vote is worth is not set here.
    """
    each = lambda c, of="n_words": F.col(c) / F.greatest(F.col(of), F.lit(1))
    return {
        "symbols": _vote(each("n_symbols") + each("n_marks"), lambda v: v < 0.02, lambda v: v > 0.1),
        "marks": _vote(each("n_marks"), lambda v: v < 0.01, lambda v: v > 0.1),
        "capitals": _vote(each("n_upper", "n_letters"), lambda v: (v > 0) & (v < 0.1), lambda v: v > 0.3),
        "word_length": _vote(each("word_chars"), lambda v: v.between(4, 6.5), lambda v: (v < 3.5) | (v > 7)),
        "one_word": _vote(each("n_top"), lambda v: v < 0.1, lambda v: v > 0.2),
        "repeats": _vote(each("n_repeat_words"), lambda v: v <= 0.05, lambda v: v > 0.2),
        "lines": _vote(each("n_dup_lines", "n_lines"), lambda v: v <= 0.1, lambda v: v > 0.3),
        "line_length": _vote(each("n_words", "n_lines"), lambda v: v.between(20, 100), lambda v: (v < 8) | (v > 300)),
        "length": _vote(F.col("n_words"), lambda v: v >= 200, lambda v: v < 100),
    }


#: Where expectation-maximisation starts: shares of good and junk texts, and how often any rule says good, junk or nothing of either.
START_SHARE = np.array([0.8, 0.2])
START_VOTES = np.array([[0.70, 0.02, 0.28], [0.45, 0.30, 0.25]])


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, weight: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Class shares (good, junk) and, for each rule, class and vote, its probability.

    ``patterns`` has a row for each pattern of votes. All rules start alike, a little better than chance; the start also
    acts as ``weight`` of the corpus all along, which keeps the classes' meaning.
    """
    n, m = max(counts.sum(), 1), patterns.shape[1]
    start = np.tile(START_VOTES, (m, 1, 1))
    share, table = START_SHARE, start
    hot = np.eye(3)[patterns]  # pattern, rule, vote
    for _ in range(rounds):
        post = posterior(patterns, share, table)
        both = np.stack([post, 1 - post], axis=1) * counts[:, None]
        new = np.einsum("pc,prv->rcv", both, hot) + weight * n * START_SHARE[None, :, None] * start
        new /= new.sum(axis=2, keepdims=True)
        new_share = (both.sum(axis=0) + weight * n * START_SHARE) / (counts.sum() + weight * n)
        moved = np.abs(new - table).max()
        share, table = new_share, new
        if moved < 1e-9:
            break
    return share, table


def accuracies(share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each rule, the estimated probability that it is right where it votes."""
    right = share[0] * table[:, 0, GOOD] + share[1] * table[:, 1, JUNK]
    return right / (share[0] * table[:, 0, [GOOD, JUNK]].sum(axis=1) + share[1] * table[:, 1, [GOOD, JUNK]].sum(axis=1))


def posterior(patterns: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Probability that a text with this pattern is good."""
    rule = np.arange(patterns.shape[1])
    logs = [np.log(share[c]) + np.log(table[rule, c, patterns]).sum(axis=1) for c in (0, 1)]
    return 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -700, 700)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _fitted(stats: DataFrame) -> tuple[dict[str, Column], np.ndarray, np.ndarray]:
    """The votes, and what EM estimates from the counts of their patterns in all texts that the base rules leave open."""
    votes = rules()
    counted = stats.where(~base_failed()).groupBy(F.concat(*[v.cast("string") for v in votes.values()]).alias("pattern")).count().collect()
    patterns = np.array([[int(c) for c in r["pattern"]] for r in counted], dtype=np.int64).reshape(-1, len(votes))
    return votes, *fit(patterns, np.array([r["count"] for r in counted], dtype=float))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rule, good_rate, junk_rate, accuracy``: how often each rule calls good texts good and junk texts junk, and is right where it votes."""
    votes, share, table = _fitted(materialize(text_statistics(docs, id_col, text_col), "stats"))
    right = accuracies(share, table)
    rows = [(name, float(table[k, 0, GOOD]), float(table[k, 1, JUNK]), float(right[k])) for k, name in enumerate(votes)]
    return docs.sparkSession.createDataFrame(rows, "rule string, good_rate double, junk_rate double, accuracy double")


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5) -> DataFrame:
    """Statistics, ``posterior``, ``n_against`` (rules that vote junk), ``base_failed`` and ``kept`` for every row of ``docs``.

    Null, empty and wordless texts have zero statistics and fail the base rules, as do texts of under fifty words or
    with over half of their words in repeated windows of three. Repeated rows and null ids are assessed as any; an empty
    table gives an empty result; other columns are ignored.
    """
    stats = materialize(text_statistics(docs, id_col, text_col), "stats")
    votes, share, table = _fitted(stats)
    odds, against = F.lit(float(np.log(share[0] / share[1]))), F.lit(0)
    for k, v in enumerate(votes.values()):
        says = np.log(table[k, 0] / table[k, 1])
        odds = odds + F.when(v == GOOD, float(says[GOOD])).when(v == JUNK, float(says[JUNK])).otherwise(float(says[NONE]))
        against = against + (v == JUNK).cast("int")
    out = stats.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("n_against", against).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
