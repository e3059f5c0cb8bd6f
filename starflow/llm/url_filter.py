"""URL verdicts: rules first, else logistic regression on hashed character n-grams.

N-grams of host and path (each with its own salt and with marks at its ends) are hashed
into a fixed number of weights.  The model is fitted by gradient steps on a small table
of labelled URLs whose bound is a parameter; it scores every URL.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.common import column, free_name, mix, ship

BITS, SHORTEST, LONGEST = 16, 3, 5
#: At most so many labelled URLs are used to fit, chosen by a hash of the URL.
MOST_LABELLED = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules, of_host: Column, of_path: Column):
    """The longest rule that fits, and its verdict; null where none does.

    A rule ``(verdict, "host/path")`` fits its host and all subdomains if the path starts
    with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decided, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((of_host == name) | of_host.endswith("." + name)) & of_path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decided)).otherwise(verdict)
    return rule, verdict


def grams(of_host: str, of_path: str) -> np.ndarray:
    """Slots of the distinct n-grams of both parts."""
    out = []
    for salt, part in ((1, of_host), (2, of_path)):
        data = np.frombuffer(b"^" + part.encode() + b"$", np.uint8).astype(np.uint64)
        for n in range(SHORTEST, LONGEST + 1):
            if len(data) >= n:
                h = np.full(len(data) - n + 1, salt * 16 + n, np.uint64)
                for k in range(n):
                    h = h * np.uint64(0x100000001B3) + data[k : k + len(h)]
                out.append(mix(h) >> np.uint64(64 - BITS))
    return np.unique(np.concatenate(out)).astype(np.int64) if out else np.zeros(0, np.int64)


def _scores(weights, hosts, paths):
    out = np.empty(len(hosts))
    for k, (h, p) in enumerate(zip(hosts, paths)):
        slots = grams(h or "", p or "")
        out[k] = weights[slots].sum() / np.sqrt(max(1, len(slots))) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def train(labelled: DataFrame, url: str = "url", label: str = "blocked", most: int = MOST_LABELLED, steps: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights from at most ``most`` distinct labelled URLs; ``label`` is 1 for block.

    Null labels are passed over; a URL with both labels counts as blocked.  Without any
    row, or with one class only, the weights are zero but for the bias.
    """
    some = labelled.where(column(label).isNotNull()).groupBy(F.coalesce(column(url), F.lit("")).alias("url"))
    some = some.agg(F.max(column(label).cast("int")).alias("y"))
    some = some.orderBy(F.xxhash64("url"), "url").limit(most)
    rows = some.select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p"), "y").collect()
    weights = np.zeros((1 << BITS) + 1)
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    if len(np.unique(y)) < 2:
        weights[-1] = 3.0 * (2 * y[0] - 1) if len(y) else -3.0
        return weights
    slots = [grams(r["h"], r["p"]) for r in rows]
    sizes = np.array([len(s) for s in slots])
    flat, owner = np.concatenate(slots), np.repeat(np.arange(len(slots)), sizes)
    scale = 1 / np.sqrt(np.maximum(1, sizes))
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    square = np.full(len(weights), 1e-8)
    for _ in range(steps):
        logit = np.bincount(owner, weights[flat], minlength=len(y)) * scale + weights[-1]
        error = (y - 1 / (1 + np.exp(-np.clip(logit, -60, 60)))) * balance
        gradient = np.bincount(flat, (error * scale)[owner], minlength=len(weights)) / len(y)
        gradient[-1] = error.mean()
        gradient -= ridge * weights
        square += gradient**2
        weights += 0.3 * gradient / np.sqrt(square)
    return weights


def judged(pages: DataFrame, rules, weights: np.ndarray, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """All columns and ``host, path, rule, score, verdict`` of each URL.

    ``score`` is the model's probability of block; the verdict is the rule's where one
    fits, else block if the score reaches the threshold.  A null URL, or one without
    ``://``, has an empty host and path and the model's verdict on those.  Names that are
    taken get a leading underscore.
    """
    spark = pages.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(weights)  # a fixed number of weights

    @F.arrow_udf("double")
    def score(hosts, paths):
        import pyarrow as pa

        return pa.array(_scores(held.value, hosts.to_pylist(), paths.to_pylist()))

    names = {n: free_name(pages, n) for n in ("host", "path", "rule", "score", "verdict")}
    out = pages.withColumn(names["host"], host(column(url))).withColumn(names["path"], path(column(url)))
    of_host, of_path = F.col(names["host"]), F.col(names["path"])
    rule, verdict = rule_of(rules, of_host, of_path)
    out = out.withColumn(names["rule"], rule).withColumn(names["score"], score(of_host, of_path))
    learned = F.when(F.col(names["score"]) >= threshold, "block").otherwise("allow")
    return out.withColumn(names["verdict"], F.coalesce(verdict, learned))
