"""Quality rules: fixed base rules, and robust outliers per language and source. DataFrame and SQL functions only.

Base: words are ``[^\\x20\\x09-\\x0D]+``. A document fails if it has fewer than 50 words, or if more than half of them lie
in 3-word windows that its text holds twice or more.

Outliers: three statistics that vary in any prose are transformed: log of the mean word length, angle (arc sine of the
root) of the share of words that end in no letter, and log of the distinct words over log of the words. For each language
and source the minimum covariance determinant is approached by concentration steps, each over all documents: the three
quarters of the group nearest by Mahalanobis distance give the next mean and covariance, so that determinants only fall.
Steps go on from two starts (medians and quartiles; mean and covariance of all) until no group's determinant falls by more
than ``SETTLED``, and a group's estimate is that of the start with the smaller one. A standard deviation, given the
statistics before it, is ``LEAST`` over the root of the median number of words at least: what counting so few words
leaves. That is no part of the estimate unless a group's statistics hardly vary. Documents beyond ``CUTOFF`` are rejected.
Groups under ``MIN_GROUP`` documents are pooled by language; what is left in pools that small is judged by the estimate
over all documents that pass the base rules. Only where all of these are fewer than ``MIN_GROUP`` is nothing rejected.

Each step is a partial aggregation of a narrow table, so a group of any size is no hot task.

Edge cases: a null or empty text has no words and fails; null language and source are a group of their own; repeated
rows are judged each; an empty table gives an empty result; other columns are carried by ``keep``. Working columns start
with ``_q_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenweb.llm.common import materialize

#: chi-square with 3 degrees of freedom: its median, the quantile that one of 10^8 is beyond, and what makes the covariance of the nearest SHARE that of all.
MEDIAN, CUTOFF, CONSISTENT = 2.366, 40.13, 1.611
#: Share of a group that a step keeps; fall of a log determinant that counts as none; steps at most.
SHARE, SETTLED, STEPS, MIN_GROUP = 0.75, 1e-3, 20, 100
#: Standard deviations that a group has at least, times the root of its median number of words.
LEAST = (0.25, 0.5, 0.1)
D = len(LEAST)
BROADCAST_ROWS = 100_000
#: The key of the estimate over all documents.
ALL = "a"
SPACE = r"[ \t\n\x0B\f\r]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more: sort the windows' hashes, take the places of equal neighbours, count what they cover."""

    def covered(places: Column) -> Column:
        return F.coalesce(F.aggregate(F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x), F.lit(0))

    def repeated(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, j: F.coalesce(x["h"] == F.get(pairs, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(pairs, j + 1)["h"], F.lit(False)))
        return _let(F.array_sort(F.transform(same, lambda x: x["i"])), covered)

    def hashes(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(pairs, repeated))

    n = F.size(words)
    windows = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 4, F.lit(0)).otherwise(_let(windows, hashes))


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    ends = F.regexp_count(text, F.lit(r"[^\p{L}\p{M} \t\n\x0B\f\r](?=[ \t\n\x0B\f\r]|\z)"))
    step = df.withColumns({"_q_w": F.array_remove(F.split(text, SPACE), ""), "_q_l": lines})
    out = {"n_words": F.size("_q_w"), "word_chars": F.length(F.array_join("_q_w", "")), "n_symbols": symbols, "n_dup_lines": F.size("_q_l") - F.size(F.array_distinct("_q_l")), "n_repeat_words": _repeat_words(F.col("_q_w")), "_q_ends": ends, "_q_distinct": F.size(F.array_distinct("_q_w"))}
    step = step.withColumns({k: v.cast("long") for k, v in out.items()}).drop("_q_w", "_q_l")
    return step.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vector() -> dict[str, Column]:
    """Of documents with two words at least."""
    n = F.greatest(F.col("n_words"), F.lit(2)).cast("double")
    return {"_q_x0": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), "_q_x1": F.asin(F.sqrt(F.least(F.col("_q_ends") / n, F.lit(1.0)))), "_q_x2": F.log(F.greatest(F.col("_q_distinct"), F.lit(1))) / F.log(n)}


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution in the Cholesky factor l_ij around the mean m_i."""
    z: list[Column] = []
    for i in range(D):
        r = F.col(f"_q_x{i}") - F.col(f"_q_m{i}")
        for j in range(i):
            r = r - F.col(f"_q_l{i}{j}") * F.col(f"_q_z{j}")
        z.append(r / F.col(f"_q_l{i}{i}"))
    return z


def _with_distance(df: DataFrame) -> DataFrame:
    for i, z in enumerate(_distance()):
        df = df.withColumn(f"_q_z{i}", z)
    return df.withColumn("_q_d", sum((F.col(f"_q_z{i}") ** 2 for i in range(1, D)), F.col("_q_z0") ** 2)).drop(*[f"_q_z{i}" for i in range(D)])


def _cholesky(df: DataFrame) -> DataFrame:
    """Columns _q_cij of a covariance to _q_lij of its factor, and _q_det, the log of its determinant."""
    least = [F.lit(x) / F.sqrt(F.greatest(F.col("_q_n"), F.lit(1.0))) for x in LEAST]
    for i in range(D):
        for j in range(i + 1):
            s = CONSISTENT * F.col(f"_q_c{i}{j}")
            for k in range(j):
                s = s - F.col(f"_q_l{i}{k}") * F.col(f"_q_l{j}{k}")
            df = df.withColumn(f"_q_l{i}{j}", F.sqrt(F.greatest(s, least[i] ** 2)) if i == j else s / F.col(f"_q_l{j}{j}"))
    det = sum((F.log(f"_q_l{i}{i}") for i in range(1, D)), F.log("_q_l00")) * 2
    return df.withColumn("_q_det", det).drop(*[f"_q_c{i}{j}" for i in range(D) for j in range(i + 1)])


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.avg(f"_q_x{i}").alias(f"_q_m{i}") for i in range(D)], *[F.covar_pop(f"_q_x{i}", f"_q_x{j}").alias(f"_q_c{i}{j}") for i in range(D) for j in range(i + 1)])


def _groups(rows: DataFrame) -> DataFrame:
    """(lang, source, group): the key under which each language and source is judged; null where the whole table is too small."""
    sizes = rows.groupBy("_q_lang", "_q_source").count()
    level = sizes.withColumn("_q_own", F.col("count") >= MIN_GROUP)
    pools = level.where("not _q_own").groupBy("_q_lang").agg(F.sum("count").alias("_q_pool"))
    level = level.join(pools, "_q_lang", "left")
    total = F.lit(int(rows.count()) >= MIN_GROUP)
    key = F.when(F.col("_q_own"), F.concat_ws("\x01", F.lit("s"), "_q_lang", "_q_source")).when(F.col("_q_pool") >= MIN_GROUP, F.concat_ws("\x01", F.lit("l"), "_q_lang")).when(total, F.lit(ALL))
    return materialize(level.select("_q_lang", "_q_source", key.alias("_q_g")), "mcd-groups")


_KEY = ("_q_g", "_q_start")


def _starts(rows: DataFrame) -> DataFrame:
    """(group, start, _q_n, mean, factor, _q_det) of the two starts of each group."""
    middle = [F.percentile_approx(f"_q_x{i}", [0.25, 0.5, 0.75]).alias(f"_q_p{i}") for i in range(D)]
    quartiles = rows.groupBy("_q_g").agg(F.percentile_approx("_q_words", 0.5).cast("double").alias("_q_n"), *middle)
    robust = quartiles.select("_q_g", "_q_n", *[F.col(f"_q_p{i}")[1].alias(f"_q_m{i}") for i in range(D)], *[((((F.col(f"_q_p{i}")[2] - F.col(f"_q_p{i}")[0]) / 1.349) ** 2) if i == j else F.lit(0.0)).alias(f"_q_c{i}{j}") for i in range(D) for j in range(i + 1)])
    whole = _moments(rows, "_q_g").join(quartiles.select("_q_g", "_q_n"), "_q_g")
    both = robust.withColumn("_q_start", F.lit(0)).unionByName(whole.withColumn("_q_start", F.lit(1)))
    return _cholesky(both).withColumn("_q_det", F.lit(float("inf")))


def _step(rows: DataFrame, now: DataFrame, hint) -> DataFrame:
    """A concentration step of every group and start, in one job."""
    far = _with_distance(rows.join(hint(now), "_q_g")).select(*_KEY, "_q_d", *[f"_q_x{i}" for i in range(D)])
    limit = far.groupBy(*_KEY).agg(F.percentile_approx("_q_d", SHARE).alias("_q_h"))
    near = far.join(hint(limit), list(_KEY)).where("_q_d <= _q_h")
    known = now.select(*_KEY, "_q_n", F.col("_q_det").alias("_q_before"))
    return materialize(_cholesky(_moments(near, *_KEY).join(hint(known), list(_KEY))), "mcd-step")


def fit(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """stats: materialized, with _q_lang, _q_source and the counts. Returns (groups, estimates by group)."""
    rows = stats.where("not base_failed").withColumns(_vector()).withColumn("_q_words", F.col("n_words"))
    groups = _groups(rows)
    # The estimate over all is made of all rows, not only of those that it judges.
    keys = F.array(F.col("_q_g")) if groups.where(F.col("_q_g") == ALL).isEmpty() else F.array_distinct(F.array("_q_g", F.lit(ALL)))
    rows = rows.join(_small(groups), ["_q_lang", "_q_source"]).where("_q_g is not null").select(F.explode(keys).alias("_q_g"), "_q_words", *[f"_q_x{i}" for i in range(D)])
    rows = materialize(rows, "mcd-rows")
    # An estimate is a row for each group and start.
    hint = F.broadcast if 2 * groups.count() <= BROADCAST_ROWS else lambda df: df
    now = materialize(_starts(rows), "mcd-step")
    for _ in range(STEPS):
        now = _step(rows, now, hint)
        falls = now.agg(F.max(F.col("_q_before") - F.col("_q_det"))).first()[0]
        now = now.drop("_q_before")
        if falls is None or falls <= SETTLED:
            break
    best = now.groupBy("_q_g").agg(F.min(F.struct("_q_det", "_q_start")).alias("_q_best")).select("_q_g", F.col("_q_best._q_start").alias("_q_start"))
    now = materialize(now.join(best, list(_KEY)).drop("_q_start"), "mcd-best")
    middle = _with_distance(rows.join(hint(now), "_q_g")).groupBy("_q_g").agg(F.percentile_approx("_q_d", 0.5).alias("_q_median"))
    # Least deviations make distances small rather than large, so they are never scaled up.
    return groups, materialize(now.join(middle, "_q_g").withColumn("_q_scale", F.greatest(F.col("_q_median") / MEDIAN, F.lit(1.0))).drop("_q_median"), "mcd-fit")


def _keyed(df: DataFrame) -> DataFrame:
    known = {k: F.coalesce(F.col(c).cast("string"), F.lit("\0")) for k, c in (("_q_lang", "lang"), ("_q_source", "source"))}
    return df.withColumns(known)


def judge(df: DataFrame, *carry: str) -> DataFrame:
    """(carried columns, base columns, base_failed, kept)."""
    stats = materialize(with_statistics(_keyed(df)).select(*carry, "_q_lang", "_q_source", *BASE, "_q_ends", "_q_distinct", "base_failed"), "quality-stats")
    groups, found = fit(stats)
    told = _with_distance(stats.withColumns(_vector()).join(_small(groups), ["_q_lang", "_q_source"], "left").join(_small(found), "_q_g", "left"))
    return told.select(*carry, *BASE, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("_q_d") <= CUTOFF * F.col("_q_scale"), F.lit(True))).alias("kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs, "doc_id").select("doc_id", *BASE, "base_failed", "kept")


def keep(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of df that are kept. A row is named by its id and its text's hash."""
    named = df.withColumns({"_q_id": F.col(id_col), "_q_hash": F.xxhash64("text")})
    gone = judge(named, "_q_id", "_q_hash").where("not kept").select(F.col("_q_id").alias("_q_gone"), F.col("_q_hash").alias("_q_gone_hash")).distinct()
    return named.join(gone, F.col("_q_id").eqNullSafe(F.col("_q_gone")) & (F.col("_q_hash") == F.col("_q_gone_hash")), "left_anti").drop("_q_id", "_q_hash")
