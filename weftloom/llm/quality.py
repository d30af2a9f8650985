"""Operator 3: quality rules by robust multivariate outliers, in DataFrame operations only.

Per language and source, a minimum-covariance-determinant estimate (location and scatter of the tightest half of
the documents) is found by concentration steps; documents far from it in Mahalanobis distance are rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.session import broadcast_if_small, materialize

_BLANK = r"\x20\x09-\x0D"
_BLANKS = " \t\n\x0b\f\r"
_SYMBOLS = "[#*$%&|<>]"


def base_statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text to the columns ``keep``."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(body, F.lit(_BLANKS))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{_BLANK}]"))
    split = docs.select(
        *keep,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_BLANK}]+")).alias("_words"),
        lines.alias("_lines"),
        F.regexp_count(body, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
    )
    n = F.size("_words")
    at = lambda start: F.slice("_words", start, F.greatest(n - 2, F.lit(0)))
    counted = split.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.arrays_zip(at(1).alias("a"), at(2).alias("b"), at(3).alias("c")).alias("_windows"),
    )
    hashed = counted.select(
        "*", F.transform("_windows", lambda w: F.xxhash64(w["a"], w["b"], w["c"])).alias("_hashes")
    ).drop("_windows")
    # hash and place in one number: its low bits, as many as the places need, are the place
    bits = F.length(F.bin("n_words")).cast("int")
    mixed = lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long"))
    # texts whose hashes all differ are settled
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = hashed.withColumn("_sorted", F.when(some, F.sort_array(F.transform("_hashes", mixed))))
    place = lambda v: v.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")
    high = lambda v: F.call_function("shiftright", v, bits)
    equal = F.filter(
        F.arrays_zip(F.col("_sorted").alias("x"), F.slice("_sorted", 2, F.size("_sorted")).alias("y")),
        lambda z: (high(z["x"]) == high(z["y"]))
        & (F.get(F.col("_hashes"), place(z["x"])) == F.get(F.col("_hashes"), place(z["y"]))),
    )
    twice = ordered.withColumn("_equal", F.when(F.col("_sorted").isNotNull(), equal)).drop("_sorted", "_hashes")
    places = F.concat(
        F.transform("_equal", lambda z: place(z["x"])), F.transform("_equal", lambda z: place(z["y"]))
    )
    placed = twice.withColumn("_places", F.sort_array(F.array_distinct(places))).drop("_equal")
    pairs = F.arrays_zip(F.col("_places").alias("here"), F.slice("_places", 2, F.size("_places")).alias("next"))
    covered = F.aggregate(
        pairs, F.lit(0), lambda acc, z: acc + F.least(F.lit(3), F.coalesce(z["next"] - z["here"], F.lit(3)))
    )
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_places")


# --- minimum covariance determinant ---
# The statements below are plain SQL that Spark and other engines run alike.

#: Transformed statistics, and the scale below which a difference in one of them means nothing. The square of the scale is added to
#: the scatter's diagonal, so that statistics that hardly vary (most texts have no symbol) leave it regular.
VECTOR = (
    ("ln(cast(word_chars AS double) / n_words)", 0.1),
    ("sqrt(cast(n_symbols AS double) / word_chars)", 0.03),
    ("sqrt(cast(n_dup_lines AS double) / n_words)", 0.05),
    ("sqrt(cast(n_repeat_words AS double) / n_words / (1 + n_words / 10000.0))", 0.1),  # phrases of long texts recur by themselves
)
CUTOFF = 33.38  # chi-squared quantile of 1 - 10^-6 with 4 degrees of freedom
CONSISTENCY = 2.11  # makes the scatter of the inner half of normal data that of all
STEPS = 6
LEAST_GROUP = 20  # documents; smaller groups take the estimate of their language, small languages that of all
_P = range(1, len(VECTOR) + 1)
_LOWER = [(i, j) for i in _P for j in range(1, i + 1)]
_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def _key(*columns: str) -> str:
    """Text that tells groups apart, nulls included."""
    parts = [f"coalesce(concat(length({c}), ':', {c}), '-')" for c in columns]
    return "concat(" + ", '/', ".join([f"'{len(columns)}/'", *parts]) + ")"


GROUP_KEYS = (_key("lang", "source"), _key("lang"), "'all'")


def vectors_sql(stats: str) -> str:
    values = ", ".join(f"{expression} AS x{i}" for i, (expression, _) in enumerate(VECTOR, 1))
    keys = ", ".join(f"{key} AS k{level}" for level, key in enumerate(GROUP_KEYS))
    return f"SELECT doc_id, {keys}, {values} FROM {stats} WHERE NOT {_FAILED}"


def points_sql(vectors: str) -> str:
    """Each document once for its group, its language and the whole table."""
    values = ", ".join(f"x{i}" for i in _P)
    return " UNION ALL ".join(f"SELECT k{level} AS k, {values} FROM {vectors}" for level in range(len(GROUP_KEYS)))


def _moments() -> dict[str, str]:
    return {"n": "count(*)"} | {f"s{i}": f"sum(x{i})" for i in _P} | {f"s{i}{j}": f"sum(x{i} * x{j})" for i, j in _LOWER}


def _inverted_sql(table: str) -> str:
    """Location u, the inverse m of the Cholesky factor l of the scatter, and the logarithm of its determinant."""
    scatter = [
        f"{CONSISTENCY} * greatest(s{i}{j} / n - s{i} * s{j} / n / n, {0 if i == j else -1e9})"
        + (f" + {VECTOR[i - 1][1] ** 2!r}" if i == j else "") + f" AS c{i}{j}"
        for i, j in _LOWER
    ]
    sql = f"SELECT k, start, total, {', '.join(f's{i} / n AS u{i}' for i in _P)}, {', '.join(scatter)} FROM {table}"
    for j in _P:  # column by column; each level only refers to finished ones
        above = "".join(f" - l{j}{q} * l{j}{q}" for q in range(1, j))
        sql = f"SELECT *, sqrt(c{j}{j}{above}) AS l{j}{j} FROM ({sql})"
        below = [
            f"(c{i}{j}" + "".join(f" - l{i}{q} * l{j}{q}" for q in range(1, j)) + f") / l{j}{j} AS l{i}{j}" for i in _P if i > j
        ]
        if below:
            sql = f"SELECT *, {', '.join(below)} FROM ({sql})"
    for i in _P:
        row = [
            "-(" + " + ".join(f"l{i}{q} * m{q}{j}" for q in range(j, i)) + f") / l{i}{i} AS m{i}{j}" for j in range(1, i)
        ]
        sql = f"SELECT *, {', '.join([*row, f'1.0 / l{i}{i} AS m{i}{i}'])} FROM ({sql})"
    kept = [f"u{i}" for i in _P] + [f"m{i}{j}" for i, j in _LOWER]
    det = " + ".join(f"2 * ln(l{i}{i})" for i in _P)
    return f"SELECT k, start, total, {', '.join(kept)}, {det} AS logdet FROM ({sql})"


def _distance(point: str, fit: str) -> str:
    rows = [" + ".join(f"{fit}.m{i}{j} * ({point}.x{j} - {fit}.u{j})" for j in range(1, i + 1)) for i in _P]
    return " + ".join(f"({row}) * ({row})" for row in rows)


def first_sql(points: str) -> str:
    """Two starts: mean and covariance of all (0), and the coordinate medians, to 0.001, with the scales alone (1)."""
    moments = ", ".join(f"{value} AS {name}" for name, value in _moments().items())
    medians = " UNION ALL ".join(
        f"SELECT k, {i} AS dim, cast(floor(1000 * x{i}) AS bigint) AS bin, count(*) AS n FROM {points} GROUP BY k, floor(1000 * x{i})"
        for i in _P
    )
    ranked = (
        "SELECT k, dim, bin, sum(n) OVER (PARTITION BY k, dim ORDER BY bin) AS upto, "
        f"sum(n) OVER (PARTITION BY k, dim) AS total FROM ({medians})"
    )
    middle = ", ".join(f"min(CASE WHEN dim = {i} THEN (bin + 0.5) / 1000 END) AS u{i}" for i in _P)
    inverse = ", ".join(f"{1 / VECTOR[i - 1][1]!r} AS m{i}{j}" if i == j else f"0.0 AS m{i}{j}" for i, j in _LOWER)
    whole = f"SELECT k, 0 AS start, count(*) AS total, {moments} FROM {points} GROUP BY k"
    names = ", ".join(["k", "start", "total", *(f"cast(u{i} AS double) AS u{i}" for i in _P), *(f"cast(m{i}{j} AS double) AS m{i}{j}" for i, j in _LOWER)])
    return (
        f"SELECT {names} FROM ({_inverted_sql(f'({whole})')}) UNION ALL SELECT {names} FROM ("
        f"SELECT k, 1 AS start, max(total) AS total, {middle}, {inverse} FROM ({ranked}) WHERE 2 * upto >= total GROUP BY k)"
    )


def step_sql(points: str, fits: str) -> str:
    """Concentration: location and scatter of the half of each group that is nearest to the last estimate.

    Documents are gathered by the logarithm of their distance in steps of 1/16, moments and all, so that a step is one
    aggregation and the half is found among a few hundred sums a group.
    """
    moments = ", ".join(f"{value} AS {name}" for name, value in _moments().items())
    upto = ", ".join(f"sum({name}) OVER (PARTITION BY k, start ORDER BY bin) AS {name}" for name in _moments())
    xs = ", ".join(f"p.x{i}" for i in _P)
    binned = (
        f"SELECT k, start, bin, {moments} FROM (SELECT p.k, f.start, {xs}, cast(floor(16 * ln(1e-12 + {_distance('p', 'f')})) AS bigint) AS bin "
        f"FROM {points} p JOIN {fits} f ON p.k = f.k) GROUP BY k, start, bin"
    )
    summed = f"SELECT k, start, bin, {upto}, sum(n) OVER (PARTITION BY k, start) AS total FROM ({binned})"
    half = f"SELECT *, row_number() OVER (PARTITION BY k, start ORDER BY bin) AS turn FROM ({summed}) WHERE 2 * n >= total"
    return _inverted_sql(f"(SELECT * FROM ({half}) WHERE turn = 1)")


def chosen_sql(vectors: str, fits: str) -> str:
    """The estimate of least determinant for each group, or for what a small group belongs to."""
    fields = ["total", *(f"u{i}" for i in _P), *(f"m{i}{j}" for i, j in _LOWER)]
    best = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY logdet, start) AS turn FROM {fits}) WHERE turn = 1"
    )
    take = ", ".join(
        f"CASE WHEN a.total >= {LEAST_GROUP} THEN a.{name} WHEN b.total >= {LEAST_GROUP} THEN b.{name} ELSE c.{name} END AS {name}"
        for name in fields
    )
    groups = f"SELECT DISTINCT k0, k1, k2 FROM {vectors}"
    return (
        f"SELECT g.k0 AS k, {take} FROM ({groups}) g JOIN ({best}) a ON a.k = g.k0 JOIN ({best}) b ON b.k = g.k1 "
        f"JOIN ({best}) c ON c.k = g.k2"
    )


def verdict_sql(stats: str, chosen: str, columns: str) -> str:
    """Add base_failed, the squared distance (null if base_failed) and kept to the columns of ``stats``."""
    values = ", ".join(f"CASE WHEN NOT {_FAILED} THEN {expression} END AS x{i}" for i, (expression, _) in enumerate(VECTOR, 1))
    inner = f"SELECT *, {_FAILED} AS base_failed, {GROUP_KEYS[0]} AS k, {values} FROM {stats}"
    measured = f"SELECT {columns}, base_failed, {_distance('p', 'f')} AS distance FROM ({inner}) p LEFT JOIN {chosen} f ON p.k = f.k"
    return f"SELECT *, NOT base_failed AND coalesce(distance <= {CUTOFF}, false) AS kept FROM ({measured})"


def quality_rules(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` columns, the statistics, ``base_failed``, ``distance`` and ``kept`` for every row of ``docs``.

    ``keep`` must hold doc_id, lang and source. A null or empty text has no words and fails the base rule, as
    do texts of fewer than 50 words and those with most words in repeated 3-word windows. The others are kept if their
    squared Mahalanobis distance from their group's estimate is at most ``CUTOFF``. Null languages and sources are groups of their own;
    repeated rows are judged alike, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    stats = materialize(base_statistics(docs, text, keep))
    run = lambda sql, **frames: spark.sql(sql, **frames)
    vectors = materialize(run(vectors_sql("{stats}"), stats=stats))
    points = run(points_sql("{vectors}"), vectors=vectors)
    fits = materialize(run(first_sql("{points}"), points=points))
    for _ in range(STEPS):
        fits = materialize(run(step_sql("{points}", "{fits}"), points=points, fits=broadcast_if_small(fits)))
    chosen = materialize(run(chosen_sql("{vectors}", "{fits}"), vectors=vectors, fits=fits))
    columns = ", ".join(f"p.{name}" for name in stats.columns)
    return run(verdict_sql("{stats}", "{chosen}", columns), stats=stats, chosen=broadcast_if_small(chosen))
