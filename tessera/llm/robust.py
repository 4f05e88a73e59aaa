"""Quality rules by robust multivariate outliers (operator 7), in DataFrame and SQL functions only.

A text's counts become five transformed statistics, kept as whole numbers (1/1024 of a natural
logarithm) so that their sums are exact in any order.  For each language and source the
minimum covariance determinant is estimated from two starts: the median deviations, and the
covariance of the rows' directions from the median (spatial signs), which far rows do not
stretch.  From each, concentration steps go over to the mean and covariance of the ``CORE``
share of rows with the smallest Mahalanobis distance; the start that ends with the smaller
determinant is kept, and a last step uses all rows that are not outlying.  Rows beyond ``CUTOFF``
are rejected.

The same is estimated for each language and for all rows.  A row of a group with fewer than ``MIN_ROWS`` rows
is judged by its language's estimate, or by that of all rows if the language has fewer too.
Each step reads the statistics once and writes one row per group and start.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

DIMENSIONS = 5
#: Words of a repeated window; share of rows that a concentration step keeps (half of them, so that the
#: estimate stands nearly as many outliers; the last step restores efficiency); such steps.
WINDOW, CORE, STEPS = 5, 0.5, 3
#: Groups with fewer rows than this are judged by the estimate of their language, then of all rows.
MIN_ROWS = 40
#: Directions from the median are kept as whole numbers, in this part of 1.
SIGN = 1024
#: Least standard deviation of each statistic, in 1/1024: smaller differences are no reason to reject.
FLOORS = (80, 512, 160, 160, 125)
#: Statistics: length of words, number of words, rates of symbols, repeated lines and repeated words;
#: the added constants hold short texts near the middle.
STATISTICS = (
    "ln((word_chars + 5e2) / (n_words + 1e2))",
    "ln(1e0 + n_words)",
    "ln(1e0 + 2e1 * n_symbols / (n_words + 2e1))",
    "ln(1e0 + 2e1 * n_dup_lines / (n_words + 2e1))",
    "ln(1e0 + 5e0 * n_repeat_words / (n_words + 2e1))",
)
_D = range(1, DIMENSIONS + 1)
_PAIRS = [(i, j) for i in _D for j in _D if i <= j]


def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function by its power series, until terms vanish."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, k) < p:
        hi *= 2
    while hi - lo > 1e-12 * hi:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """Factor that makes the covariance of the inner ``share`` of a normal sample unbiased."""
    return share / chi2_cdf(chi2_quantile(share, DIMENSIONS), DIMENSIONS + 2)


#: Rows up to the first quantile enter the last estimate, rows beyond the second are rejected.
INNER, CUTOFF = chi2_quantile(0.975, DIMENSIONS), chi2_quantile(0.99999, DIMENSIONS)

# Shared expressions; each may use the names before it.
WHOLE = [(f"z{i}", f"CAST(floor(1024e0 * {s} + 5e-1) AS BIGINT)") for i, s in enumerate(STATISTICS, 1)]
SUMS = [("n", "count(*)"), *[(f"s{i}", f"sum(z{i})") for i in _D], *[(f"s{i}{j}", f"sum(z{i} * z{j})") for i, j in _PAIRS]]


def moments(factor: float) -> list[tuple[str, str]]:
    """Centre, covariance (times ``factor``) from the sums."""
    means = [(f"m{i}", f"CAST(s{i} AS DOUBLE) / n") for i in _D]
    return means + [(f"c{i}{j}", f"{factor!r} * (CAST(s{i}{j} AS DOUBLE) / n - m{i} * m{j})" + (f" + {FLOORS[i - 1] ** 2}e0" if i == j else ""))
                    for i, j in _PAIRS]


def _cholesky() -> list[tuple[str, str]]:
    out = []
    for j in _D:
        done = "".join(f" - l{j}{k} * l{j}{k}" for k in range(1, j))
        out.append((f"l{j}{j}", f"sqrt(greatest(c{j}{j}{done}, 1e0))"))
        for i in range(j + 1, DIMENSIONS + 1):
            done = "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
            out.append((f"l{i}{j}", f"(c{j}{i}{done}) / l{j}{j}"))
    return out


CHOLESKY = _cholesky()
DISTANCE = [(f"y{i}", f"(z{i} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(1, i)) + f") / l{i}{i}") for i in _D]
DISTANCE += [("d2", " + ".join(f"y{i} * y{i}" for i in _D))]
#: Distances in fine logarithmic bins, of which a group has some thousands at most.
BIN = "CAST(floor(256e0 * ln(1e0 + d2)) AS BIGINT)"


def _with(df: DataFrame, named: list[tuple[str, str]]) -> DataFrame:
    for name, text in named:
        df = df.withColumn(name, F.expr(text))
    return df


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, the group columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Windows of one text are compared by a 64-bit hash of the words' 64-bit hashes.
    """
    sep = r"[\x20\x09-\x0D]+"
    df = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(c) for c in groups], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    df = df.withColumn("_w", F.array_remove(F.split("_t", sep), ""))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_h")
    windows = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))
    df = df.select("doc_id", *groups, n.cast("long").alias("n_words"),
                   F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                   F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                   (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                   F.when(n >= WINDOW, windows).alias("_v"))
    # Windows found twice, by their sorted hashes; each covers WINDOW words, less where the next begins.
    again = F.size(F.array_distinct("_v")) < F.size("_v")
    order = F.array_sort(F.transform("_v", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(again, order))
    df = df.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda x, j: F.coalesce(F.get("_s", j - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get("_s", j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
    covered = F.aggregate(F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select("doc_id", *groups, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", groups: tuple[str, str] = ("lang", "source"),
             cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance2.

    Base rule: under 10 words, or over a fifth of the words in repeated windows.  Estimates use the
    rows that pass it, and only those can be kept.  Null groups are groups; groups under
    ``MIN_ROWS`` rows are judged by their language, then by all rows.  ``distance2`` is null where the base
    rule fails, and only there.  Null texts have no word and fail.
    Repeated rows and null ids stay.  An empty table gives an empty one.  Only the named columns
    are read.
    """
    g = ["_g1", "_g2"]
    counts = base_counts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                                     *[F.col(c).alias(n) for c, n in zip(groups, g, strict=True)]), groups=tuple(g))
    rows = written(_with(counts.withColumn("base_failed", F.expr(FAILED)), WHOLE), "quality-rows")
    passed = rows.where(~F.col("base_failed")).select(*g, *[f"z{i}" for i in _D])

    # Each row once per level: its language and source, its language, all rows.
    level = ["_v", *g]
    passed = (passed.withColumn("_v", F.explode(F.array(*[F.lit(v) for v in LEVELS])))
              .withColumn("_g2", F.when(F.col("_v") == 0, F.col("_g2"))).withColumn("_g1", F.when(F.col("_v") < 2, F.col("_g1"))))

    def beside(left, state, keys):
        small = state.withColumnsRenamed({k: f"_k{k}" for k in keys})
        meet = F.lit(True)
        for k in keys:
            meet = meet & F.col(k).eqNullSafe(F.col(f"_k{k}"))
        return left.join(small, meet, "left").drop(*[f"_k{k}" for k in keys])

    def estimate(kept, factor, keys):
        sums = kept.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in SUMS])
        return written(_with(sums, moments(factor) + CHOLESKY).select(*keys, *_STATE), "quality-state")

    middle = written(passed.groupBy(*level).agg(*[F.expr(f"percentile(z{i}, 0.5)").alias(f"m{i}") for i in _D]), "quality-state")
    spread = written(beside(passed, middle, level).groupBy(*level).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(f"m{i}").alias(f"m{i}") for i in _D],
        *[F.expr(f"percentile(abs(z{i} - m{i}), 0.5)").alias(f"a{i}") for i in _D]), "quality-state")
    signs = _with(beside(passed, spread, level), SIGNS).groupBy(*level).agg(
        *[F.max(c).alias(c) for c in ("n", *[f"m{i}" for i in _D], *[f"a{i}" for i in _D])], *[F.expr(text).alias(name) for name, text in SIGN_SUMS])
    state = written(_with(spread, START + CHOLESKY).select(*level, F.lit(0).alias("_b"), *_STATE)
                    .unionByName(_with(signs, SIGN_START + CHOLESKY).select(*level, F.lit(1).alias("_b"), *_STATE)), "quality-state")
    both = [*level, "_b"]
    for _ in range(STEPS):
        scored = _with(beside(passed, state, level), [*DISTANCE, ("bin", BIN)])
        cut = written(scored.groupBy(*both).agg(F.expr(f"floor(percentile(bin, {CORE}))").alias("cut")), "quality-cut")
        state = estimate(beside(scored.drop("n"), cut, both).where("bin <= cut"), consistency(CORE), both)
    least = state.groupBy(*level).agg(F.min_by(F.struct(*_STATE), F.struct(F.expr(DETERMINANT), F.col("_b"))).alias("s")).select(*level, "s.*")
    state = estimate(_with(beside(passed, least, level), DISTANCE).where(f"d2 <= {INNER!r}"), consistency(0.975), level)
    sized = written(beside(state, spread.select(*level, F.col("n").alias("size")), level), "quality-state")
    # The estimate that judges each group: its own, its language's or that of all rows.
    params = F.struct(*_STATE)
    own = sized.where("_v = 0").select(*g, F.when(F.col("size") >= MIN_ROWS, params).alias("p0"))
    wide = sized.where((F.col("_v") == 1) & (F.col("size") >= MIN_ROWS)).select("_g1", params.alias("p1"))
    every = sized.where("_v = 2").select(F.lit(0).alias("_one"), params.alias("p2"))
    judges = beside(beside(own, wide, ["_g1"]).withColumn("_one", F.lit(0)), every, ["_one"])
    judges = judges.select(*g, F.coalesce("p0", "p1", "p2").alias("p")).select(*g, "p.*")
    judged = _with(beside(rows, judges, g), DISTANCE)
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    return judged.select(F.col("doc_id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"), distance.alias("distance2"))


#: First scatter: median deviations on the diagonal.
START = [(f"c{i}{j}", f"(14826e-4 * a{i}) * (14826e-4 * a{i}) + {FLOORS[i - 1] ** 2}e0" if i == j else "0e0") for i, j in _PAIRS]
#: Second scatter: the covariance of the directions from the median, each scaled by its median deviation.
_SCALE = [f"sqrt((14826e-4 * a{i}) * (14826e-4 * a{i}) + {FLOORS[i - 1] ** 2}e0)" for i in _D]
SIGNS = [(f"u{i}", f"(z{i} - m{i}) / {_SCALE[i - 1]}") for i in _D]
SIGNS += [("r", "greatest(sqrt(" + " + ".join(f"u{i} * u{i}" for i in _D) + "), 1e-9)")]
SIGNS += [(f"k{i}", f"CAST(floor({SIGN}e0 * u{i} / r + 5e-1) AS BIGINT)") for i in _D]
SIGN_SUMS = [(f"p{i}{j}", f"sum(k{i} * k{j})") for i, j in _PAIRS]
SIGN_START = [(f"c{i}{j}", f"{DIMENSIONS}e0 * (CAST(p{i}{j} AS DOUBLE) / n / {SIGN ** 2}e0) * ({_SCALE[i - 1]} * {_SCALE[j - 1]})"
               + (f" + {FLOORS[i - 1] ** 2}e0" if i == j else "")) for i, j in _PAIRS]
DETERMINANT = " * ".join(f"l{i}{i}" for i in _D)
LEVELS = (0, 1, 2)
_STATE = ["n", *[f"m{i}" for i in _D], *[name for name, _ in CHOLESKY]]


def _list(named: list[tuple[str, str]]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in named)


def oracle_sql() -> str:
    """DuckDB SQL for ``verdicts`` over ``documents`` (without distance2).

    Repeated windows are found by grouping the windows as text; the estimates follow the same steps.
    """
    def nest(source: str, named, keep: str = "*") -> str:
        for name, text in named:
            source = f"(SELECT {keep}, {text} AS {name} FROM {source})"
        return source

    state = ", ".join(_STATE)
    with_state = "SELECT p.*, {cols} FROM passed p JOIN {s} t ON p.v = t.v AND p.lang IS NOT DISTINCT FROM t.lang AND p.source IS NOT DISTINCT FROM t.source"
    cols = ", ".join(f"t.{c}" for c in _STATE)
    parts = [f"""words AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)""",
             """spots AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words)""",
             f"""windows AS (SELECT rid, i, word || {" || ' ' || ".join(f"lead(word, {k}) OVER p" for k in range(1, WINDOW))} AS v
  FROM spots WINDOW p AS (PARTITION BY rid ORDER BY i))""",
             """marked AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS c FROM windows WHERE v IS NOT NULL)""",
             f"""gaps AS (SELECT rid, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, {WINDOW})) AS covered FROM marked WHERE c > 1)""",
             """repeats AS (SELECT rid, CAST(sum(covered) AS BIGINT) AS n_repeat_words FROM gaps GROUP BY rid)""",
             """counts AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
    - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS BIGINT) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM words LEFT JOIN repeats USING (rid))""",
             f"rows_ AS (SELECT *, ({FAILED}) AS base_failed, {_list(WHOLE)} FROM counts)",
             f"""passed AS (SELECT v, CASE WHEN v < 2 THEN lang END AS lang, CASE WHEN v = 0 THEN source END AS source, {', '.join(f'z{i}' for i in _D)}
  FROM rows_, (SELECT unnest([{', '.join(map(str, LEVELS))}]) AS v) WHERE NOT base_failed)""",
             f"middle AS (SELECT v, lang, source, {', '.join(f'median(z{i}) AS m{i}' for i in _D)} FROM passed GROUP BY v, lang, source)"]
    off = with_state.format(cols=", ".join(f"t.m{i}" for i in _D), s="middle")
    parts.append(f"spread AS (SELECT v, lang, source, count(*) AS n, {', '.join(f'max(m{i}) AS m{i}' for i in _D)}, "
                 f"{', '.join(f'median(abs(z{i} - m{i})) AS a{i}' for i in _D)} FROM ({off}) GROUP BY v, lang, source)")
    known = ["n", *[f"m{i}" for i in _D], *[f"a{i}" for i in _D]]
    signed = nest("(" + with_state.format(cols=", ".join(f"t.{c}" for c in known), s="spread") + ")", SIGNS)
    parts.append(f"signs AS (SELECT v, lang, source, {', '.join(f'max({c}) AS {c}' for c in known)}, {_list(SIGN_SUMS)} FROM {signed} GROUP BY v, lang, source)")
    parts.append(f"state0 AS (SELECT v, lang, source, 0 AS b, {state} FROM {nest('spread', START + CHOLESKY)} "
                 f"UNION ALL SELECT v, lang, source, 1, {state} FROM {nest('signs', SIGN_START + CHOLESKY)})")
    sums = "SELECT {keys}, " + _list(SUMS) + " FROM ({rows}) GROUP BY {keys}"
    both = "v, lang, source, b"
    for k in range(STEPS):
        parts.append(f"scored{k} AS (SELECT * FROM {nest('(' + with_state.format(cols='t.b, ' + cols, s=f'state{k}') + ')', [*DISTANCE, ('bin', BIN)])})")
        parts.append(f"cut{k} AS (SELECT {both}, floor(quantile_cont(bin, {CORE})) AS cut FROM scored{k} GROUP BY {both})")
        inner = (f"SELECT s.* EXCLUDE (n) FROM scored{k} s JOIN cut{k} c ON s.v = c.v AND s.b = c.b AND s.lang IS NOT DISTINCT FROM c.lang "
                 "AND s.source IS NOT DISTINCT FROM c.source WHERE s.bin <= c.cut")
        parts.append(f"state{k + 1} AS (SELECT {both}, {state} FROM {nest('(' + sums.format(rows=inner, keys=both) + ')', moments(consistency(CORE)) + CHOLESKY)})")
    parts.append(f"least_ AS (SELECT * FROM state{STEPS} QUALIFY row_number() OVER (PARTITION BY v, lang, source ORDER BY {DETERMINANT}, b) = 1)")
    last = f"SELECT * EXCLUDE (n) FROM {nest('(' + with_state.format(cols=cols, s='least_') + ')', DISTANCE)} WHERE d2 <= {INNER!r}"
    grouped = nest("(" + sums.format(rows=last, keys="v, lang, source") + ")", moments(consistency(0.975)) + CHOLESKY)
    parts.append(f"final_ AS (SELECT f.*, s.n AS size FROM (SELECT v, lang, source, {state} FROM {grouped}) f "
                 "JOIN spread s ON f.v = s.v AND f.lang IS NOT DISTINCT FROM s.lang AND f.source IS NOT DISTINCT FROM s.source)")
    pick = ", ".join(f"CASE WHEN o.size >= {MIN_ROWS} THEN o.{c} WHEN w.size >= {MIN_ROWS} THEN w.{c} ELSE e.{c} END AS {c}" for c in _STATE)
    parts.append(f"judges AS (SELECT o.lang, o.source, {pick} FROM final_ o LEFT JOIN final_ w ON w.v = 1 AND w.lang IS NOT DISTINCT FROM o.lang "
                 "LEFT JOIN final_ e ON e.v = 2 WHERE o.v = 0)")
    judged = nest(f"(SELECT r.*, {cols} FROM rows_ r LEFT JOIN judges t ON r.lang IS NOT DISTINCT FROM t.lang AND r.source IS NOT DISTINCT FROM t.source)", DISTANCE)
    return (f"WITH {', '.join(parts)} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
            f"NOT base_failed AND coalesce(d2 <= {CUTOFF!r}, true) AS kept FROM {judged}")
