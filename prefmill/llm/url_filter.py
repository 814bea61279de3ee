"""URL filters: host and path rules first, boosted trees on lexical features for the rest.

DataFrame and SQL functions only. The rules are a short list and become one
CASE. The URLs that a rule fits are the labelled ones: boosted trees learn
from their features (lengths, depth, digit share, character entropy, number of
parameters, suffix statistics) to tell blocked from allowed, and judge the
URLs that no rule fits. A labelled URL's suffix statistics leave out the labels
of its own fold, so that no label enters its own features. Features are cut into a few bins, equal rows are
counted once, and each level of a tree is one aggregation of gradients by
feature and bin; gradients are summed as whole numbers, so the trees don't
depend on the order of rows. The trees become one SQL expression.

Edge cases: a null url, or one without '://', has an empty host and path, fits
no rule and is judged by its features (those of the empty string); with no
labelled url, or of one verdict only, the rest gets the more frequent verdict,
allow if there is none; repeated rows are judged each; a null page_id is kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import stored

#: (verdict, host, path); a rule fits its host and all subdomains.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Bin edges of each feature: a value's bin is the number of edges at or below it.
EDGES: dict[str, list[float]] = {
    "url_length": [20, 28, 34, 40, 46, 54, 70, 120],
    "host_length": [4, 12, 16, 18, 20, 23, 26, 32],
    "host_labels": [1, 2, 3, 4, 5],
    "depth": [1, 2, 3, 4, 6],
    "path_length": [1, 4, 8, 9, 10, 12, 20, 40],
    "digit_share": [0.02, 0.06, 0.09, 0.11, 0.13, 0.16, 0.25, 0.5],
    "entropy": [2.0, 3.0, 3.4, 3.7, 3.9, 4.1, 4.3, 4.6],
    "n_params": [1, 2, 3, 5],
    "n_hyphens": [1, 2, 4],
    "suffix_share": [0.001, 0.01, 0.05, 0.2],
    "suffix_blocked": [0.05, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95],
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Statistics of up to so many suffixes are broadcast; more of them are joined by a shuffle.
BROADCAST_KEYS = 10_000
#: Folds of the labelled URLs, by a hash of the URL: equal URLs share one.
FOLDS = 5
#: Rows by which a suffix's blocked share is drawn to the overall one.
PRIOR_ROWS = 10
#: Gradients are summed as multiples of 1 / SCALE.
SCALE = 1_000_000


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return pages.withColumns({"host": F.translate(F.regexp_extract(u, pattern, 1), UPPER, LOWER), "path": F.regexp_extract(u, pattern, 2)})


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        name = F.when(fits, F.lit(host + path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def features(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add the lexical features, the suffix and the fold."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1))
    digits = F.length(u) - F.length(F.translate(u, "0123456789", ""))
    # the counts of the characters, one by one: each takes away its own from the string
    share = "(length(_u) - length(replace(_u, c, ''))) / greatest(length(_u), 1)"
    entropy = f"aggregate(array_distinct(split(_u, '')), 0D, (acc, c) -> acc + coalesce(CASE WHEN c <> '' THEN -({share}) * log2({share}) END, 0D))"
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return pages.withColumn("_u", u).withColumns(
        {
            "url_length": F.length(u).cast("double"),
            "host_length": F.length("host").cast("double"),
            "host_labels": F.when(F.col("host") == "", 0).otherwise(F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1).cast("double"),
            "depth": (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double"),
            "path_length": F.length("path").cast("double"),
            "digit_share": digits / n,
            "entropy": F.expr(entropy),
            "n_params": F.when(query == "", 0).otherwise(F.length(query) - F.length(F.translate(query, "&;", "")) + 1).cast("double"),
            "n_hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double"),
            "_suffix": F.substring_index("host", ".", -1),
            "_fold": F.pmod(F.xxhash64("_u"), F.lit(FOLDS)).cast("int"),
        }
    )


def _with_statistics(rows: DataFrame) -> DataFrame:
    """Add each suffix's share of all URLs and its smoothed blocked share.

    Statistics are taken over all rows, pre-aggregated; a labelled row's blocked
    share is that of the other folds. They are stored and counted, and broadcast
    only where they prove small.
    """
    blocked, known = F.count_if(F.col("_verdict") == "block"), F.count("_verdict")
    by_fold = rows.groupBy("_suffix", "_fold").agg(F.count(F.lit(1)).alias("n"), blocked.alias("b"), known.alias("k"))
    stats = by_fold.groupBy("_suffix").agg(
        F.sum("n").alias("_n"), F.sum("b").alias("_b"), F.sum("k").alias("_k"), F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("b", "k")))).alias("_folds")
    )
    stats = stored(stats, "statistics")
    total = stats.agg(F.sum("_n").alias("n"), F.sum("_b").alias("b"), F.sum("_k").alias("k"), F.count(F.lit(1)).alias("keys")).first()
    prior = ((total["b"] or 0) + 1) / ((total["k"] or 0) + 2)
    rows = rows.join(F.broadcast(stats) if total["keys"] <= BROADCAST_KEYS else stats.hint("merge"), "_suffix", "left")
    own = F.when(F.col("_verdict").isNotNull(), F.col("_folds")[F.col("_fold")])
    b, k = (F.coalesce(F.col(f"_{c}") - F.coalesce(own[c], F.lit(0)), F.lit(0)) for c in "bk")
    return rows.withColumns({"suffix_blocked": (b + PRIOR_ROWS * prior) / (k + PRIOR_ROWS), "suffix_share": F.coalesce(F.col("_n") / max(1, total["n"] or 0), F.lit(0.0))}).drop("_n", "_b", "_k", "_folds")


def binned(name: str) -> Column:
    out = F.lit(0)
    for k, edge in enumerate(EDGES[name], 1):
        out = F.when(F.col(name) >= edge, k).otherwise(out)
    return out.cast("int")


@dataclass
class Boosted:
    """Trees as nested (feature, bin, low, high) or leaf values; ``base`` is the first log-odds."""

    base: float
    trees: list

    def expression(self) -> Column:
        """The log-odds of 'block' as one SQL expression over the bins."""
        out = F.lit(float(self.base))
        for t in self.trees:
            out = out + self._tree(t)
        return out

    def _tree(self, t) -> Column:
        if not isinstance(t, tuple):
            return F.lit(float(t))
        name, cut, low, high = t
        return F.when(F.col(f"_b_{name}") < cut, self._tree(low)).otherwise(self._tree(high))


def _leaf(g: float, h: float, rate: float, ridge: float) -> float:
    return round(rate * g / (h + ridge), 9)


def boost(bins: DataFrame, rounds: int = 10, depth: int = 2, rate: float = 0.4, ridge: float = 1.0, least: float = 1e-6) -> Boosted:
    """Fit on counted rows: bin columns ``_b_*``, ``_pos`` (blocked) and ``_neg`` (allowed).

    Every level is one pass over the counted rows, which gives at most
    2^depth x features x bins sums.
    """
    names = list(EDGES)
    total = bins.agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n")).first()
    pos, neg = total["p"] or 0, total["n"] or 0
    if not pos or not neg:
        return Boosted(1.0 if pos > neg else -1.0, [])
    model = Boosted(round(math.log(pos / neg), 9), [])
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-model.expression()))
        now = bins.withColumns(
            {
                "_g": F.round((F.col("_pos") * (1 - p) - F.col("_neg") * p) * SCALE).cast("long"),
                "_h": F.round((F.col("_pos") + F.col("_neg")) * p * (1 - p) * SCALE).cast("long"),
            }
        )
        splits: dict[int, tuple[str, int]] = {}
        values: dict[int, tuple[float, float]] = {}
        for level in range(depth):
            node = F.lit(1)
            for k in sorted(splits):  # heap numbers: children of k are 2k and 2k + 1
                node = F.when(node == k, F.when(F.col(f"_b_{splits[k][0]}") < splits[k][1], 2 * k).otherwise(2 * k + 1)).otherwise(node)
            pairs = ", ".join(f"'{n}', `_b_{n}`" for n in names)
            tall = now.withColumn("_node", node).select("_node", "_g", "_h", F.expr(f"stack({len(names)}, {pairs}) AS (_feature, _bin)"))
            sums: dict[tuple[int, str], dict[int, tuple[int, int]]] = {}
            for r in tall.groupBy("_node", "_feature", "_bin").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect():
                sums.setdefault((r["_node"], r["_feature"]), {})[r["_bin"]] = (r["g"], r["h"])
            for k in range(1 << level, 2 << level):
                best = None
                for f in names:
                    hist = sums.get((k, f))
                    if not hist:
                        continue
                    g_all, h_all = (sum(v[i] for v in hist.values()) / SCALE for i in (0, 1))
                    values.setdefault(k, (g_all, h_all))
                    g = h = 0.0
                    for b in sorted(hist)[:-1]:
                        g, h = g + hist[b][0] / SCALE, h + hist[b][1] / SCALE
                        gain = g * g / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                        if gain > least and (best is None or gain > best[0] + 1e-12):
                            best = (gain, f, b + 1, g, h, g_all - g, h_all - h)
                if best:
                    splits[k] = (best[1], best[2])
                    values[2 * k], values[2 * k + 1] = (best[3], best[4]), (best[5], best[6])

        def grown(k: int):
            if k in splits:
                return (*splits[k], grown(2 * k), grown(2 * k + 1))
            return _leaf(*values.get(k, (0.0, 0.0)), rate, ridge)

        model.trees.append(grown(1))
        if not splits:
            break
    return model


def labelled(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, host, path, rule, the rule's verdict as ``_verdict``, and the lexical features."""
    name, verdict = rule_columns(rules)
    rows = parsed(pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url")))
    return features(rows.withColumns({"rule": name, "_verdict": verdict}))


def scored(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Fit on the rows with a ``_verdict``; stored rows with their bins, and the log-odds of 'block' over these."""
    bins = [f"_b_{n}" for n in EDGES]
    rows = stored(_with_statistics(rows).withColumns({f"_b_{n}": binned(n) for n in EDGES}).drop("_u", "_suffix", "url", *EDGES), "urls")
    known = rows.where(F.col("_verdict").isNotNull()).groupBy(*bins)
    counted = stored(known.agg(F.count_if(F.col("_verdict") == "block").alias("_pos"), F.count_if(F.col("_verdict") == "allow").alias("_neg")), "url-bins")
    return rows, boost(counted).expression()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (the trees' probability) of every page."""
    rows, odds = scored(labelled(pages, RULES if rules is None else rules, page_id, url))
    return rows.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("_verdict", F.when(odds >= 0, "block").otherwise("allow")).alias("verdict"),
        (1 / (1 + F.exp(-odds))).alias("block_score"),
    )


def held_out(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """verdict (the rule's), predicted, rows: the trees on the labelled URLs of fold 0, fitted without these labels."""
    rows = labelled(pages, RULES if rules is None else rules).withColumn("_truth", F.col("_verdict"))
    rows, odds = scored(rows.withColumn("_verdict", F.when(F.col("_fold") > 0, F.col("_verdict"))))
    test = rows.where((F.col("_fold") == 0) & F.col("_truth").isNotNull())
    return test.groupBy(F.col("_truth").alias("verdict"), F.when(odds >= 0, "block").otherwise("allow").alias("predicted")).agg(F.count(F.lit(1)).alias("rows"))
