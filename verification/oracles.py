"""DuckDB SQL for the queries, written independently of the operators."""

from verification.views import SQL_VIEWS


def _with(view: str, *steps: str) -> str:
    """Common table expressions: a stand-in view named ``src``, then further steps."""
    return "WITH RECURSIVE src AS (" + SQL_VIEWS[view] + ")" + "".join(",\n" + s for s in steps) + "\n"


def _tagged(name: str = "tagged", source: str = "src") -> str:
    return (
        f"{name} AS (SELECT reach_id, date, streamflow, CAST(year(date) + "
        f"CASE WHEN month(date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year FROM {source})"
    )


YEAR_SIZES = (
    "year_sizes AS (SELECT reach_id, water_year, count(*) AS days, count(streamflow) AS flows, "
    "CASE WHEN (water_year % 4 = 0 AND water_year % 100 <> 0) OR water_year % 400 = 0 THEN 366 ELSE 365 END AS expected "
    "FROM tagged GROUP BY ALL)"
)
ENDS = "ends AS (SELECT reach_id, min(water_year) AS first_wy, max(water_year) AS last_wy FROM year_sizes GROUP BY 1)"
BAD = (
    "bad AS (SELECT reach_id, water_year FROM year_sizes JOIN ends USING (reach_id) "
    "WHERE days < expected AND water_year IN (first_wy, last_wy))"
)
TRIMMED = "trimmed AS (SELECT * FROM tagged ANTI JOIN bad USING (reach_id, water_year))"


def _trim(view: str, *steps: str) -> str:
    return _with(view, _tagged(), YEAR_SIZES, ENDS, BAD, TRIMMED, *steps)


R2 = lambda x: f"round_even(({x}) * 100, 0) / 100"
# A billionth is added first, so that exact half-way values round the same way
# whatever the last bit of a sum is.
R6 = lambda x, name: f"round(CAST({x} AS DOUBLE) + 1e-9, 6) AS {name}"

# Percentile levels, as text of the list.
LEVELS = "[2,5,10,15,20,25,30,33,35,40,45,50,55,60,65,66,70,75,80,85,90,95,99]"
SORTED = "sorted AS (SELECT reach_id, list_sort(list(streamflow)) AS v, count(*) AS n FROM {t} WHERE streamflow IS NOT NULL GROUP BY 1)"
PERCENTILES = (
    f"ranks AS (SELECT reach_id, v, n, level, least(greatest((n + 1) * level / 100.0, 1), n) AS r "
    f"FROM sorted, (SELECT unnest({LEVELS}) AS level)),\n"
    "pct AS (SELECT reach_id, level, n, v[1] AS low, v[n] AS high, "
    "v[CAST(floor(r) AS BIGINT)] + (v[CAST(least(floor(r) + 1, n) AS BIGINT)] - v[CAST(floor(r) AS BIGINT)]) "
    "* (r - floor(r)) AS q FROM ranks)"
)


def _percentiles(table: str) -> tuple[str, str]:
    return SORTED.format(t=table), PERCENTILES


VECTOR = (
    "vec AS (SELECT reach_id, CAST(0 AS BIGINT) AS position, low AS q FROM pct WHERE level = 50 UNION ALL "
    "SELECT reach_id, CAST(list_position([2,5,10,20,25,30,50,75,90,95,99], level) AS BIGINT), q FROM pct "
    "WHERE level IN (2,5,10,20,25,30,50,75,90,95,99) UNION ALL "
    "SELECT reach_id, 12, high FROM pct WHERE level = 50)"
)
VARIABILITY = (
    "vi AS (SELECT reach_id, stddev_samp(log10(greatest(q, 0.001))) AS variability_index FROM pct "
    "WHERE level % 5 = 0 GROUP BY 1)"
)
SLOPE = (
    "slope AS (SELECT reach_id, (ln(greatest(max(q) FILTER (level = 66), 0.001)) "
    "- ln(greatest(max(q) FILTER (level = 33), 0.001))) / 33 AS slope_fdc FROM pct GROUP BY 1)"
)

FLASH = (
    "steps AS (SELECT *, abs(streamflow - lag(streamflow) OVER (PARTITION BY reach_id, water_year ORDER BY date)) AS step FROM trimmed)",
    "flash AS (SELECT reach_id, water_year, CASE WHEN count(*) >= 2 AND count(*) = count(streamflow) AND sum(streamflow) > 0 "
    "THEN sum(step) / sum(streamflow) END AS fi FROM steps GROUP BY 1, 2)",
)


def _periods(periods: list[tuple[int, int]]) -> str:
    parts = [
        f"SELECT reach_id, CAST({i} AS BIGINT) AS position, avg(fi) FILTER (water_year BETWEEN {a} AND {b}) AS v FROM flash GROUP BY 1"
        for i, (a, b) in enumerate(periods)
    ]
    a, b = periods[-1]
    inside = f"FILTER (water_year BETWEEN {a} AND {b})"
    parts.append(
        f"SELECT reach_id, {len(periods)}, CASE WHEN avg(fi) {inside} <> 0 THEN stddev_samp(fi) {inside} * 100 / avg(fi) {inside} END "
        "FROM flash GROUP BY 1"
    )
    return "periods AS (" + " UNION ALL ".join(parts) + ")"


PERIODS = [(1980, 1989), (1990, 1999), (2000, 2009), (2010, 2022)]
LATE_PERIODS = [(1980, 1989), (1996, 2001)]

WEEK = (
    "week AS (SELECT *, CASE WHEN count(streamflow) OVER w = 7 THEN avg(streamflow) OVER w END AS mean_7 FROM trimmed "
    "WINDOW w AS (PARTITION BY reach_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"
)
WEEK_YEARS = (
    "week_years AS (SELECT reach_id, water_year, count(*) AS days, CAST(count(*) FILTER (mean_7 IS NULL) AS BIGINT) AS null_7, "
    "min(mean_7) AS min_7 FROM week GROUP BY 1, 2)"
)
USABLE = "usable AS (SELECT * FROM week_years WHERE days > 328 AND null_7 / days < 0.1)"
ALL_REACHES = "reaches AS (SELECT DISTINCT reach_id FROM trimmed)"


def _probability(target: float) -> str:
    return (
        "zero_years AS (SELECT reach_id, water_year, max(CASE WHEN streamflow < 0.001 THEN 1.0 ELSE 0.0 END) AS z FROM trimmed GROUP BY 1, 2),\n"
        f"prob AS (SELECT reach_id, avg(z) AS p0, CASE WHEN avg(z) = 1 OR avg(z) >= {target} THEN 0.0 "
        f"ELSE greatest(least(({target} - avg(z)) / (1 - avg(z)), 1 - 1e-6), 1e-6) END AS p FROM zero_years GROUP BY 1)"
    )


MOMENTS = (
    "logs AS (SELECT reach_id, log10(min_7) AS x FROM usable WHERE min_7 > 0)",
    "moments AS (SELECT reach_id, count(*) AS n, avg(x) AS mean_log, stddev_samp(x) AS sd_log, "
    "CASE WHEN count(*) >= 3 THEN CASE WHEN var_pop(x) * count(*) < 1e-14 THEN 0 ELSE skewness(x) END END AS skew_log "
    "FROM logs GROUP BY 1)",
)

# Pearson III quantile by bisection on a power series of the incomplete gamma
# function; good for the moderate skews of the test tables.
QUANTILE = (
    "shapes AS (SELECT reach_id, p, mean_log, sd_log, skew_log, 4 / (skew_log * skew_log) AS a, "
    "CASE WHEN skew_log > 0 THEN p ELSE 1 - p END AS tail FROM moments JOIN prob USING (reach_id) WHERE skew_log <> 0 AND p > 0)",
    "bisect AS (SELECT reach_id, a, tail, 0 AS i, CAST(0 AS DOUBLE) AS lo, a + 40 * sqrt(a) + 40 AS hi FROM shapes UNION ALL "
    "SELECT reach_id, a, tail, i + 1, CASE WHEN cdf < tail THEN mid ELSE lo END, CASE WHEN cdf < tail THEN hi ELSE mid END FROM ("
    "SELECT *, list_sum(list_transform(range(0, CAST(mid + 60 * sqrt(mid) + 200 AS BIGINT)), "
    "lambda k: exp((a + k) * ln(mid) - mid - lgamma(a + k + 1)))) AS cdf FROM ("
    "SELECT *, (lo + hi) / 2 AS mid FROM bisect WHERE i < 60)))",
    "factors AS (SELECT reach_id, sign(skew_log) * ((lo + hi) / 2 - s.a) / sqrt(s.a) AS k, p, mean_log, sd_log "
    "FROM bisect JOIN shapes s USING (reach_id) WHERE i = 60 UNION ALL "
    "SELECT reach_id, NULL, p, mean_log, sd_log FROM moments JOIN prob USING (reach_id) WHERE skew_log IS NOT NULL AND p = 0)",
    "q10 AS (SELECT reach_id, CASE WHEN p = 0 THEN CASE WHEN sd_log > 0 THEN 0.0 END ELSE pow(10, mean_log + sd_log * k) END AS seven_q10 FROM factors)",
)

MARKS = (
    "limits AS (SELECT reach_id, avg(streamflow) * 0.2 AS low, greatest(median(streamflow) * 9, 0.001) AS high FROM trimmed GROUP BY 1)",
    "marks AS (SELECT t.*, coalesce(streamflow < 0.001, false) AS is_zero, coalesce(streamflow < low, false) AS is_low, "
    "coalesce(streamflow > high, false) AS is_high FROM trimmed t JOIN limits USING (reach_id))",
)


def _runs(flag: str, name: str) -> str:
    return (
        f"{name} AS (SELECT reach_id, min(date) AS start_date, count(*) AS duration FROM (SELECT reach_id, date, {flag} AS f, "
        "row_number() OVER (PARTITION BY reach_id ORDER BY date) - row_number() OVER (PARTITION BY reach_id, "
        f"{flag} ORDER BY date) AS island FROM marks) WHERE f GROUP BY reach_id, island)"
    )


def _days_and_duration(flag: str, runs: str, days: str, duration: str, name: str) -> str:
    return (
        f"{name} AS (SELECT reach_id, {days}, CASE WHEN {days} = 0 THEN 0 ELSE d END AS {duration} FROM "
        f"(SELECT reach_id, avg(n) AS {days} FROM (SELECT reach_id, water_year, count(*) FILTER ({flag}) AS n FROM marks GROUP BY 1, 2) GROUP BY 1) "
        f"LEFT JOIN (SELECT reach_id, avg(duration) AS d FROM {runs} GROUP BY 1) USING (reach_id))"
    )


HALF = (
    "cumulated AS (SELECT *, sum(streamflow) OVER (PARTITION BY reach_id, water_year ORDER BY date) AS c, "
    "sum(streamflow) OVER (PARTITION BY reach_id, water_year) AS total FROM trimmed)",
    "half AS (SELECT reach_id, water_year, min(date) FILTER (streamflow IS NOT NULL AND c >= total / 2) AS half_flow_date "
    "FROM cumulated GROUP BY 1, 2)",
    "half_days AS (SELECT *, date_diff('day', make_date(water_year, 1, 1), half_flow_date) + 1 AS day FROM half)",
)

CALENDAR = (
    "calendar AS (SELECT reach_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM trimmed GROUP BY 1)",
    "filled AS (SELECT c.reach_id, c.date, t.streamflow FROM calendar c LEFT JOIN trimmed t ON c.reach_id = t.reach_id AND c.date = t.date)",
)
SEASON = CALENDAR + (
    "season AS (SELECT reach_id, date, CASE WHEN count(*) OVER w = 180 AND count(streamflow) OVER w >= 150 "
    "THEN avg(streamflow) OVER w END AS season_mean FROM filled "
    "WINDOW w AS (PARTITION BY reach_id ORDER BY date ROWS BETWEEN CURRENT ROW AND 179 FOLLOWING))",
    "season_years AS (SELECT reach_id, year(date) AS year, bool_or(season_mean IS NULL) AS has_gap FROM season GROUP BY 1, 2)",
    "starts AS (SELECT reach_id, year, date AS start_date FROM (SELECT s.reach_id, y.year, s.date, "
    "row_number() OVER (PARTITION BY s.reach_id, y.year ORDER BY season_mean DESC, s.date) AS rn FROM season s "
    "JOIN season_years y ON s.reach_id = y.reach_id AND year(s.date) = y.year WHERE NOT has_gap AND y.year BETWEEN 1980 AND 2021) WHERE rn = 1)",
)

BASE = (
    "flows AS MATERIALIZED (SELECT reach_id, date, streamflow AS q, row_number() OVER (PARTITION BY reach_id ORDER BY date) AS i FROM trimmed WHERE streamflow IS NOT NULL)",
    "near AS (SELECT *, lag(q) OVER w AS before, lead(q) OVER w AS after, lead(q, 2) OVER w AS after2, "
    "quantile_cont(q, 0.9) OVER (PARTITION BY reach_id) AS big FROM flows WINDOW w AS (PARTITION BY reach_id ORDER BY date))",
    "wet1 AS (SELECT *, (after - before) / 2 AS slope, coalesce((after - before) / 2 >= 0, true) AS wet, "
    "q >= big AND coalesce(q >= before, true) AND after < q AS peak FROM near)",
    "wet2 AS (SELECT *, coalesce(lead(slope) OVER (PARTITION BY reach_id ORDER BY i) < slope, true) AS steeper, "
    "bool_or(wet) OVER (PARTITION BY reach_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS near_wet, "
    "bool_or(peak) OVER (PARTITION BY reach_id ORDER BY i ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS near_peak FROM wet1)",
    "strict AS (SELECT reach_id, date, i, q, slope, NOT (steeper OR near_wet OR coalesce(near_peak, false)) AS strict, "
    "coalesce(before > after2, false) AS falls FROM wet2)",
    "rates AS (SELECT reach_id, list_sort(list(-slope / q) FILTER (strict)) AS r FROM strict GROUP BY 1)",
    "recession AS (SELECT reach_id, exp(-r[CAST(floor(len(r) * 0.05) AS BIGINT) + 1]) AS recession FROM rates)",
    "spells AS (SELECT *, i - row_number() OVER (PARTITION BY reach_id, falls ORDER BY i) AS island FROM strict)",
    "late AS (SELECT *, falls AND count(*) OVER (PARTITION BY reach_id, falls, island) >= 10 AND "
    "row_number() OVER (PARTITION BY reach_id, falls, island ORDER BY i) > ceil(count(*) OVER (PARTITION BY reach_id, falls, island) * 0.6) AS recedes FROM spells)",
)
LYNE_HOLLICK = (
    "fwd AS (SELECT reach_id, i, q, q AS b FROM flows WHERE i = 1 UNION ALL "
    "SELECT f.reach_id, f.i, f.q, least(f.q, 0.925 * w.b + 0.0375 * (w.q + f.q)) FROM fwd w JOIN flows f ON f.reach_id = w.reach_id AND f.i = w.i + 1)",
    "back AS (SELECT f.reach_id, f.i, f.b AS f, f.b FROM fwd f JOIN (SELECT reach_id, max(i) AS i FROM flows GROUP BY 1) USING (reach_id, i) UNION ALL "
    "SELECT f.reach_id, f.i, f.b, least(f.b, 0.925 * w.b + 0.0375 * (w.f + f.b)) FROM back w JOIN fwd f ON f.reach_id = w.reach_id AND f.i = w.i - 1)",
)
ECKHARDT = (
    "eck AS (SELECT f.reach_id, f.i, b.b FROM flows f JOIN back b USING (reach_id, i) WHERE f.i = 1 UNION ALL "
    "SELECT f.reach_id, f.i, least(f.q, (0.2 * 0.98 * w.b + 0.02 * 0.8 * f.q) / (1 - 0.98 * 0.8)) FROM eck w JOIN flows f ON f.reach_id = w.reach_id AND f.i = w.i + 1)",
)


# Keyed recursion: one row per reach and candidate, advanced a day at a time.
CALIBRATION = (
    "days AS MATERIALIZED (SELECT l.reach_id, l.i, l.q, l.recedes, r.recession AS a FROM late l JOIN recession r USING (reach_id) "
    "WHERE r.recession IS NOT NULL)",
    "spread AS MATERIALIZED (SELECT reach_id, count(*) AS n, coalesce(var_pop(q) FILTER (recedes) * count(*) FILTER (recedes), 0) AS ss_rec, "
    "coalesce(var_pop(q) FILTER (NOT recedes) * count(*) FILTER (NOT recedes), 0) AS ss_oth FROM days GROUP BY 1)",
    "firsts AS MATERIALIZED (SELECT reach_id, b FROM back WHERE i = 1)",
    "cand(reach_id, m, i, b, rec, oth, held) USING KEY (reach_id, m) AS (SELECT d.reach_id, CAST(k / 1000.0 AS DOUBLE), d.i, least(d.q, b.b), "
    "CASE WHEN d.recedes THEN pow(d.q - b.b, 2) ELSE 0 END, CASE WHEN d.recedes THEN 0 ELSE pow(d.q - b.b, 2) END, 0 "
    "FROM days d JOIN firsts b USING (reach_id), range(1, 1000) r(k) WHERE d.i = 1 UNION "
    "SELECT reach_id, m, i, least(q, raw), rec + CASE WHEN recedes THEN pow(q - least(q, raw), 2) ELSE 0 END, "
    "oth + CASE WHEN recedes THEN 0 ELSE pow(q - least(q, raw), 2) END, held + CASE WHEN raw > q THEN 1 ELSE 0 END "
    "FROM (SELECT d.reach_id, w.m, d.i, d.q, d.recedes, w.rec, w.oth, w.held, "
    "(1 - w.m) * d.a / (1 - d.a * w.m) * w.b + (1 - d.a) * w.m / (1 - d.a * w.m) * d.q AS raw "
    "FROM cand w JOIN days d ON d.reach_id = w.reach_id AND d.i = w.i + 1))",
    "loss AS (SELECT reach_id, m, 1 - (1 - (rec / (ss_rec + 1e-10) + 1e-10) / (oth / (ss_oth + 1e-10) + 1e-10)) * (1 - held / n) AS loss "
    "FROM cand JOIN spread USING (reach_id) WHERE i = n)",
    "best AS MATERIALIZED (SELECT reach_id, m FROM (SELECT *, row_number() OVER (PARTITION BY reach_id ORDER BY loss, m) AS rn FROM loss) WHERE rn = 1)",
    "total(reach_id, i, b, sum_b) USING KEY (reach_id) AS (SELECT reach_id, 1, b, b FROM firsts UNION "
    "SELECT reach_id, i, least(q, raw), sum_b + least(q, raw) FROM (SELECT d.reach_id, d.i, d.q, w.sum_b, "
    "(1 - m) * d.a / (1 - d.a * m) * w.b + (1 - d.a) * m / (1 - d.a * m) * d.q AS raw "
    "FROM total w JOIN days d ON d.reach_id = w.reach_id AND d.i = w.i + 1 JOIN best ON best.reach_id = d.reach_id))",
    "bfi AS (SELECT t.reach_id, t.sum_b / f.q AS baseflow_index FROM total t JOIN (SELECT reach_id, sum(q) AS q FROM days GROUP BY 1) f USING (reach_id))",
)


def _flood(extra: str = "") -> str:
    return (
        "flood AS (SELECT reach_id, CAST(round_even(median(dayofyear(start_date)), 0) AS INTEGER) AS start_date_flood_season "
        f"FROM starts GROUP BY 1{extra})"
    )


LOW = (_runs("is_low", "low_runs"), _days_and_duration("is_low", "low_runs", "low_flow_days_n", "duration_low_flow_event", "low"))
HIGH = (_runs("is_high", "high_runs"), _days_and_duration("is_high", "high_runs", "high_flow_days_n", "duration_high_flow_event", "high"))
ZERO = "zero AS (SELECT reach_id, avg(n) AS zero_flow_days_n FROM (SELECT reach_id, water_year, count(*) FILTER (is_zero) AS n FROM marks GROUP BY 1, 2) GROUP BY 1)"
MONTHS = (
    f"months AS (SELECT reach_id, month(date) AS month, {R2('avg(streamflow)')} AS mean, "
    f"{R2('CASE WHEN avg(streamflow) <> 0 THEN stddev_samp(streamflow) / avg(streamflow) * 100 END')} AS cov FROM {{t}} GROUP BY 1, 2)"
)
HALF_SUMMARY = (
    "half_sum AS (SELECT reach_id, avg(day) AS mean_day, CASE WHEN avg(day) <> 0 THEN stddev_pop(day) * 100 / avg(day) END AS cov FROM half_days GROUP BY 1)"
)
STATUS = (
    "kept AS (SELECT * FROM year_sizes ANTI JOIN bad USING (reach_id, water_year))",
    "status AS (SELECT r.reach_id, coalesce(min(flows) > 0, false) AS computed FROM (SELECT DISTINCT reach_id FROM src) r "
    "LEFT JOIN kept USING (reach_id) GROUP BY 1)",
)


def _long(name: str, position: str, value: str, source: str) -> str:
    return f"SELECT reach_id, '{name}' AS name, CAST({position} AS BIGINT) AS position, CAST({value} AS DOUBLE) AS value FROM {source}"


def _record_steps(view: str) -> str:
    """Ends with ``placed``: all indices, one row per reach, index and position."""
    numbered = "(SELECT *, row_number() OVER (PARTITION BY reach_id ORDER BY month) - 1 AS pos FROM months)"
    parts = [
        _long("monthwise_mean", "pos", "coalesce(mean, -99)", numbered),
        _long("monthwise_cov", "pos", "coalesce(cov, -99)", numbered),
        _long("nth_percentile_flows", "position", "coalesce(q, -99)", "vec"),
        _long("variability_index", "0", "variability_index", "vi"),
        _long("slope_fdc", "0", "slope_fdc", "slope"),
        _long("flashiness_index", "position", "coalesce(v, -99)", "periods"),
        _long("sevenQ10", "0", "seven_q10", "q10"),
        _long("mean_annual_7_day_min", "0", "avg(min_7)", "usable GROUP BY 1"),
        _long("baseflow_index", "0", "baseflow_index", "bfi"),
        _long("zero_flow_days_n", "0", "zero_flow_days_n", "zero"),
        _long("low_flow_days_n", "0", "low_flow_days_n", "low"),
        _long("duration_low_flow_event", "0", "duration_low_flow_event", "low"),
        _long("high_flow_days_n", "0", "high_flow_days_n", "high"),
        _long("duration_high_flow_event", "0", "duration_high_flow_event", "high"),
        _long("half_flow_date", "0", "coalesce(mean_day, -99)", "half_sum"),
        _long("half_flow_date", "1", "coalesce(cov, -99)", "half_sum"),
        _long("start_date_flood_season", "0", "start_date_flood_season", "flood"),
    ]
    steps = (
        *STATUS, MONTHS.format(t="trimmed"), *_percentiles("trimmed"), VECTOR, VARIABILITY, SLOPE, *FLASH, _periods(PERIODS),
        WEEK, WEEK_YEARS, USABLE, _probability(0.1), *MOMENTS, *QUANTILE, *MARKS, ZERO, *LOW, *HIGH, *HALF, HALF_SUMMARY, *SEASON, _flood(),
        *BASE, *LYNE_HOLLICK, *CALIBRATION,
        "record AS (" + " UNION ALL ".join(parts) + ")",
        "failed AS (SELECT reach_id, name, unnest(range(0, size)) AS position, CAST(-99 AS DOUBLE) AS value FROM status, (VALUES "
        "('monthwise_mean', 12), ('monthwise_cov', 12), ('nth_percentile_flows', 13), ('flashiness_index', 5), ('half_flow_date', 2)) l(name, size) "
        "WHERE NOT computed)",
    )
    placed = (
        "placed AS (SELECT reach_id, name, position, round(value + 1e-9, 6) AS value FROM (SELECT r.* FROM record r "
        "JOIN status USING (reach_id) WHERE computed AND value IS NOT NULL UNION ALL SELECT * FROM failed))"
    )
    return _trim(view, *steps, placed)


def _record(view: str) -> str:
    return _record_steps(view) + "SELECT * FROM placed"


# The record's fields that are lists, and those that are single numbers.
LIST_FIELDS = ["monthwise_mean", "monthwise_cov", "nth_percentile_flows", "flashiness_index", "half_flow_date"]
NUMBER_FIELDS = [
    "variability_index", "slope_fdc", "sevenQ10", "mean_annual_7_day_min", "baseflow_index", "zero_flow_days_n", "low_flow_days_n",
    "duration_low_flow_event", "high_flow_days_n", "duration_high_flow_event", "start_date_flood_season",
]


def _wide_record(view: str) -> str:
    """One row per reach, lists as lists."""
    lists = [f"list(value ORDER BY position) FILTER (name = '{n}') AS {n}" for n in LIST_FIELDS]
    numbers = [f"max(value) FILTER (name = '{n}')" + ("::INTEGER" if n.startswith("start") else "") + f" AS {n}" for n in NUMBER_FIELDS]
    return _record_steps(view) + f"SELECT reach_id, {', '.join([*lists, *numbers])} FROM placed GROUP BY reach_id"




REACH_RANK = "ids AS (SELECT DISTINCT feature_id FROM src)"

SPARSE_GRID = (
    _with("sparse_cells", "grid AS (SELECT * FROM (SELECT DISTINCT feature_id FROM src), (SELECT DISTINCT time FROM src))")
    + "SELECT feature_id, time, streamflow, velocity FROM grid LEFT JOIN src USING (feature_id, time)"
)
FIRST_DATE = (
    "kept_years AS (SELECT reach_id, low, high, min(date) AS first FROM (SELECT reach_id, min(year) AS low, max(year) AS high FROM starts GROUP BY 1) "
    "JOIN season USING (reach_id) WHERE year(date) = low GROUP BY ALL), "
    "all_years AS (SELECT reach_id, first, unnest(range(CAST(low AS BIGINT), CAST(high AS BIGINT) + 1)) AS year FROM kept_years), "
    "first_date AS (SELECT a.reach_id, CAST(round_even(median(dayofyear(coalesce(s.start_date, a.first))), 0) AS INTEGER) AS start_date_flood_season "
    "FROM all_years a LEFT JOIN starts s ON s.reach_id = a.reach_id AND s.year = a.year GROUP BY 1)"
)

ORACLES = {
    "daily_mean": _with("hourly")
    + "SELECT feature_id AS reach_id, CAST(time AS DATE) AS date, "
    + R6("CASE WHEN count(*) = count(streamflow) THEN avg(streamflow) END", "streamflow")
    + " FROM src GROUP BY 1, 2",
    "daily_mean_with_missing": _with("hourly", "nulled AS (SELECT feature_id, time, CASE WHEN streamflow >= 1 THEN streamflow END AS q FROM src)")
    + "SELECT feature_id AS reach_id, CAST(time AS DATE) AS date, "
    + R6("CASE WHEN count(*) = count(q) THEN avg(q) END", "streamflow")
    + " FROM nulled GROUP BY 1, 2",
    "retrospective_rows": "SELECT user_id AS feature_id, ts AS time, round(CAST(CAST(CASE WHEN value >= 1 THEN value END AS FLOAT) AS DOUBLE), 4) AS streamflow, "
    "round(CAST(CAST(CASE WHEN value < 100 THEN value / 100 END AS FLOAT) AS DOUBLE), 4) AS velocity, CAST(NULL AS DOUBLE) AS \"qBtmVertRunoff\", "
    "round(CAST(CAST(CASE WHEN value < 300 THEN value END AS FLOAT) AS DOUBLE), 4) AS \"qBucket\", CAST(NULL AS DOUBLE) AS \"qSfcLatRunoff\", "
    "CAST(NULL AS DOUBLE) AS q_lateral FROM events",
    "hourly_csv": "SELECT user_id AS feature_id, ts AS time, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS streamflow FROM events",
    "text_records": _trim("daily_gappy", MONTHS.format(t="trimmed"))
    + "SELECT reach_id, CAST(month AS INTEGER) AS month, mean AS monthwise_mean, cov AS monthwise_cov FROM months",
    "reach_list_select": _with("hourly") + "SELECT * FROM src WHERE feature_id IN (SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20)",
    "reach_table_select": _with("hourly") + "SELECT * FROM src WHERE feature_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "reach_slice_select": _with("hourly", "ranked AS (SELECT *, dense_rank() OVER (ORDER BY feature_id) - 1 AS pos FROM src)")
    + "SELECT feature_id, time, streamflow FROM ranked WHERE pos >= 5",
    "time_slice_select": _with("cells", "ranked AS (SELECT *, dense_rank() OVER (ORDER BY time) - 1 AS pos FROM src)")
    + "SELECT feature_id, time, streamflow, velocity FROM ranked WHERE pos < 15",
    "first_rows_per_reach": _with("hourly", "ranked AS (SELECT *, row_number() OVER (PARTITION BY feature_id ORDER BY time, streamflow) AS pos FROM src)")
    + "SELECT feature_id, time, streamflow FROM ranked WHERE pos <= 40",
    "series_union": "SELECT * FROM (" + SQL_VIEWS["daily_dense"] + ") UNION ALL SELECT * FROM (" + SQL_VIEWS["daily_gappy"] + ")",
    "water_years": _with("daily_dense")
    + "SELECT reach_id, date, CAST(year(date) + CASE WHEN month(date) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS water_year, "
    "CAST(year(date) - CASE WHEN month(date) < 4 THEN 1 ELSE 0 END AS INTEGER) AS april_year FROM src",
    "water_year_trim": _trim("daily_gappy") + "SELECT reach_id, date, water_year, " + R6("streamflow", "streamflow") + " FROM trimmed",
    "reach_status_sparse": _trim("daily_sparse", *STATUS) + "SELECT * FROM status",
    "reach_status_blank": _trim("daily_blank", *STATUS) + "SELECT * FROM status",
    "monthwise_stats": _trim("daily_missing", MONTHS.format(t="trimmed"))
    + "SELECT reach_id, CAST(month AS INTEGER) AS month, mean AS monthwise_mean, cov AS monthwise_cov FROM months",
    "weibull_percentiles": _trim("daily_sparse", *_percentiles("trimmed"))
    + "SELECT reach_id, CAST(level AS INTEGER) AS level, " + R6("q", "flow") + " FROM pct",
    "fdc_vector": _trim("daily_sparse", *_percentiles("trimmed"), VECTOR)
    + "SELECT reach_id, CAST(position AS INTEGER) AS position, " + R6("q", "flow") + " FROM vec",
    "variability_index": _trim("daily_intermittent", *_percentiles("trimmed"), VARIABILITY)
    + "SELECT reach_id, " + R6("variability_index", "variability_index") + " FROM vi",
    "fdc_slope": _trim("daily_sparse", *_percentiles("trimmed"), SLOPE) + "SELECT reach_id, " + R6("slope_fdc", "slope_fdc") + " FROM slope",
    "flashiness_yearly": _trim("daily_gappy", *FLASH) + "SELECT reach_id, water_year, " + R6("fi", "flashiness") + " FROM flash",
    "flashiness_yearly_missing": _trim("daily_missing_early", *FLASH) + "SELECT reach_id, water_year, " + R6("fi", "flashiness") + " FROM flash",
    "flashiness_periods": _trim("daily_gappy", *FLASH, _periods(PERIODS))
    + "SELECT reach_id, CAST(position AS INTEGER) AS position, " + R6("v", "value") + " FROM periods",
    "flashiness_periods_late": _trim("daily_gappy", *FLASH, _periods(LATE_PERIODS))
    + "SELECT reach_id, CAST(position AS INTEGER) AS position, " + R6("v", "value") + " FROM periods",
    "seven_day_mean": _trim("daily_missing", WEEK) + "SELECT reach_id, date, " + R6("mean_7", "mean_7") + " FROM week",
    "seven_day_min": _trim("daily_missing", WEEK, WEEK_YEARS) + "SELECT reach_id, water_year, days, null_7, " + R6("min_7", "min_7") + " FROM week_years",
    "mam7": _trim("daily_missing_early", ALL_REACHES, WEEK, WEEK_YEARS, USABLE)
    + "SELECT reach_id, " + R6("avg(min_7)", "mean_annual_7_day_min") + " FROM reaches LEFT JOIN usable USING (reach_id) GROUP BY 1",
    "zero_year_probability": _trim("daily_rare_zero", _probability(0.1)) + "SELECT reach_id, " + R6("p", "probability") + " FROM prob",
    "zero_year_probability_wide": _trim("daily_rare_zero", _probability(0.9)) + "SELECT reach_id, " + R6("p", "probability") + " FROM prob",
    "zero_year_probability_mixed": _trim("daily_rare_zero", _probability(0.6)) + "SELECT reach_id, " + R6("p", "probability") + " FROM prob",
    "lp3_moments": _trim("daily_gappy", ALL_REACHES, WEEK, WEEK_YEARS, USABLE, *MOMENTS)
    + "SELECT reach_id, coalesce(n, 0) AS n, " + R6("mean_log", "mean_log") + ", " + R6("sd_log", "sd_log") + ", " + R6("skew_log", "skew_log")
    + " FROM reaches LEFT JOIN moments USING (reach_id)",
    "seven_q10": _trim("daily_gappy", ALL_REACHES, WEEK, WEEK_YEARS, USABLE, _probability(0.1), *MOMENTS, *QUANTILE)
    + "SELECT reach_id, " + R6("seven_q10", "seven_q10") + " FROM reaches LEFT JOIN q10 USING (reach_id)",
    "zero_flow_days": _trim("daily_intermittent", *MARKS, ZERO) + "SELECT reach_id, " + R6("zero_flow_days_n", "zero_flow_days_n") + " FROM zero",
    "low_flow_events": _trim("daily_intermittent", *MARKS, *LOW)
    + "SELECT reach_id, " + R6("low_flow_days_n", "low_flow_days_n") + ", " + R6("duration_low_flow_event", "duration_low_flow_event") + " FROM low",
    "high_flow_events": _trim("daily_intermittent", *MARKS, *HIGH)
    + "SELECT reach_id, " + R6("high_flow_days_n", "high_flow_days_n") + ", " + R6("duration_high_flow_event", "duration_high_flow_event") + " FROM high",
    "low_flow_durations": _trim("daily_intermittent", *MARKS, _runs("is_low", "r")) + "SELECT reach_id, start_date, duration FROM r",
    "high_flow_durations": _trim("daily_intermittent", *MARKS, _runs("is_high", "r")) + "SELECT reach_id, start_date, duration FROM r",
    "half_flow_date_yearly": _trim("daily_missing", *HALF) + "SELECT reach_id, water_year, half_flow_date, CAST(day AS INTEGER) AS day FROM half_days",
    "half_flow_summary": _trim("daily_gappy", *HALF, HALF_SUMMARY)
    + "SELECT reach_id, " + R6("mean_day", "mean_day") + ", " + R6("cov", "cov") + " FROM half_sum",
    "calendar_fill": _trim("daily_sparse", *CALENDAR) + "SELECT reach_id, date, " + R6("streamflow", "streamflow") + " FROM filled",
    "season_means": _trim("daily_missing", *SEASON) + "SELECT reach_id, date, " + R6("season_mean", "season_mean") + " FROM season",
    "season_gap_years": _trim("daily_missing", *SEASON) + "SELECT reach_id, CAST(year AS INTEGER) AS year, has_gap FROM season_years",
    "season_starts": _trim("daily_gappy", *SEASON) + "SELECT reach_id, CAST(year AS INTEGER) AS year, start_date FROM starts",
    "flood_season_start": _trim("daily_dense", *SEASON, _flood()) + "SELECT * FROM flood",
    "strict_baseflow": _trim("daily_missing", *BASE) + "SELECT reach_id, date, " + R6("slope", "slope") + ", strict FROM strict",
    "recession_constant": _trim("daily_gappy", *BASE) + "SELECT reach_id, " + R6("recession", "recession") + " FROM recession",
    "recession_spells": _trim("daily_smooth", *BASE) + "SELECT reach_id, date, recedes FROM late",
    "lyne_hollick": _trim("daily_dense", *BASE[:1], *LYNE_HOLLICK)
    + "SELECT reach_id, date, " + R6("b", "baseflow") + " FROM back JOIN flows USING (reach_id, i)",
    "eckhardt_fixed": _trim("daily_dense", *BASE[:1], *LYNE_HOLLICK, *ECKHARDT)
    + "SELECT reach_id, date, " + R6("b", "baseflow") + " FROM eck JOIN flows USING (reach_id, i)",
    "baseflow_index": _trim("daily_smooth", *BASE, *LYNE_HOLLICK, *CALIBRATION)
    + "SELECT reach_id, " + R6("baseflow_index", "baseflow_index") + " FROM bfi",
    "sanitize_record": _with("daily_missing")
    + "SELECT reach_id, date, streamflow AS scalar, CASE WHEN streamflow IS NULL THEN -99.0 ELSE streamflow END AS element, "
    "streamflow AS nested, strftime(CAST(date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS moment FROM src",
    "chunk_roundtrip": _with("cells", "grid AS (SELECT * FROM (SELECT DISTINCT feature_id FROM src), (SELECT DISTINCT time FROM src))")
    + "SELECT feature_id, time, streamflow, velocity FROM grid LEFT JOIN src USING (feature_id, time)",
    "grid_summary": _with("cells_missing")
    + "SELECT count(DISTINCT feature_id) AS feature_count, count(DISTINCT time) AS time_count, min(feature_id) AS first_feature, max(feature_id) AS last_feature, "
    "min(time) AS first_time, max(time) AS last_time, " + R6("avg(CASE WHEN streamflow IS NULL THEN 1 ELSE 0 END)", "streamflow_missing") + ", "
    + R6("avg(CASE WHEN velocity IS NULL THEN 1 ELSE 0 END)", "velocity_missing") + " FROM src",
    "indices_record": _wide_record("daily_gappy"),
    "indices_record_long": _record("daily_gappy"),
    "reach_list_checked": _with("hourly")
    + "SELECT * FROM src WHERE feature_id IN (SELECT feature_id FROM src GROUP BY 1 ORDER BY round(sum(streamflow), 3) DESC, feature_id LIMIT 20)",
    "retrospective_overwrite": "WITH runs AS (SELECT user_id AS feature_id, CAST(ts + to_years(CAST(user_id % 3 AS INTEGER)) AS TIMESTAMP) AS time FROM events) "
    "SELECT 'first' AS run, * FROM runs WHERE feature_id % 3 = 1 UNION ALL SELECT 'second', * FROM runs",
    "indices_overwrite": _record_steps("daily_gappy")
    + "SELECT 'first' AS run, * FROM placed WHERE reach_id < 3 UNION ALL SELECT 'second', * FROM placed",
    "run_commit_log": "WITH runs AS (SELECT 'first' AS run_id, user_id, value FROM events WHERE user_id % 5 = 0 "
    "UNION ALL SELECT 'second', user_id, value FROM events WHERE user_id % 3 < 2) "
    "SELECT run_id, user_id AS reach_id, count(*) AS hours, round(sum(CAST(CAST(value AS FLOAT) AS DOUBLE)), 1) AS total, CAST(1 AS BIGINT) AS records FROM runs GROUP BY 1, 2",
    "daily_csv": _with("daily_dense") + "SELECT reach_id, date, " + R6("streamflow", "streamflow") + " FROM src",
    "flood_season_first_date": _trim("daily_missing", *SEASON, FIRST_DATE, _flood())
    + "SELECT reach_id, start_date_flood_season, 'skip' AS mode FROM flood UNION ALL SELECT reach_id, start_date_flood_season, 'first_date' FROM first_date",
    "chunk_roundtrip_small_blocks": SPARSE_GRID,
    "chunk_roundtrip_large_blocks": SPARSE_GRID,
    "broken_chunks": _with(
        "cells",
        "times AS (SELECT time, (dense_rank() OVER (ORDER BY time) - 1) // 48 % 2 AS odd FROM (SELECT DISTINCT time FROM src))",
        "places AS (SELECT * FROM (SELECT DISTINCT feature_id FROM src), times)",
        "grid AS (SELECT feature_id, time, odd, streamflow FROM places LEFT JOIN src USING (feature_id, time))",
    )
    + "SELECT feature_id % 10 AS part, count(*) FILTER (odd = 0) AS cells, count(streamflow) FILTER (odd = 0) AS filled, "
    "count(*) FILTER (odd = 1) AS broken FROM grid GROUP BY 1",
    "indices_record_sparse_long": _record("daily_sparse"),
    "indices_record_blank_long": _record("daily_blank"),
}

ORACLES["retrospective_table"] = ORACLES["retrospective_rows"]
ORACLES["rechunk_blocks"] = ORACLES["chunk_roundtrip"].replace("SELECT feature_id, time, streamflow, velocity FROM grid", "SELECT size, feature_id, time, streamflow, velocity FROM (VALUES (100), (250)) AS sizes(size), grid")
ORACLES["daily_mean_from_blocks"] = (
    _with("coarse_cells", "grid AS (SELECT * FROM (SELECT DISTINCT feature_id FROM src), (SELECT DISTINCT time FROM src))")
    + "SELECT feature_id AS reach_id, CAST(time AS DATE) AS date, "
    + R6("CASE WHEN count(*) = count(streamflow) THEN avg(streamflow) END", "streamflow")
    + " FROM grid LEFT JOIN src USING (feature_id, time) GROUP BY 1, 2"
)
ORACLES["reach_table_blocks"] = ORACLES["chunk_roundtrip"] + (
    " WHERE feature_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey % 20 = 3)"
)
ORACLES["broken_blocks"] = _with(
    "cells",
    "reaches AS (SELECT feature_id, (row_number() OVER (ORDER BY feature_id) - 1) // 10 AS part FROM (SELECT DISTINCT feature_id FROM src))",
    "times AS (SELECT time, (row_number() OVER (ORDER BY time) - 1) // 168 AS stretch FROM (SELECT DISTINCT time FROM src))",
    "bad AS (SELECT * FROM (VALUES (0, 3), (2, 5), (3, 7)) AS bad(stretch, part))",
) + (
    "SELECT part, count(*) FILTER (bad.stretch IS NULL) AS cells, CASE WHEN count(bad.stretch) > 0 THEN count(DISTINCT bad.stretch) END AS blocks, "
    "CASE WHEN count(bad.stretch) > 0 THEN count(bad.stretch) END AS lost FROM (reaches CROSS JOIN times) AS grid LEFT JOIN bad USING (stretch, part) GROUP BY 1"
)
ORACLES["zarr_blosc_scan"] = ORACLES["chunk_roundtrip"].replace("streamflow, velocity FROM grid", "streamflow, round(velocity, 2) AS velocity FROM grid")
ORACLES["daily_mean_unnamed"] = (
    _with("hourly_some_unnamed") + "SELECT feature_id AS reach_id, CAST(time AS DATE) AS date, " + R6("avg(streamflow)", "streamflow") + " FROM src GROUP BY 1, 2"
)
ORACLES["memory_rows"] = (
    "SELECT user_id AS feature_id, ts AS time, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS streamflow, CAST(NULL AS DOUBLE) AS velocity "
    "FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 5"
)
ORACLES["reach_table_absent"] = "SELECT c_custkey AS feature_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"
ORACLES["chunk_roundtrip_with_empty"] = ORACLES["chunk_roundtrip"]
ORACLES["job_tables"] = (
    _record_steps("daily_single") + "SELECT placed.*, hours FROM placed JOIN (SELECT reach_id, count(*) AS hours FROM src GROUP BY 1) USING (reach_id)"
)
ORACLES["text_shards"] = ORACLES["text_records"]
ORACLES["indices_appended_years"] = ORACLES["indices_record"]
ORACLES["indices_record_from_store"] = ORACLES["indices_record"]
ORACLES["zarr_scan"] = ORACLES["chunk_roundtrip"]
ORACLES["indices_records_table"] = ORACLES["indices_record_long"]
