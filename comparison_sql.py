"""DuckDB SQL for the registered queries, over the views of the sample tables."""

# The wording of prompts, written out here so that a slip in the library shows.
PROMPT_OPENING = (
    'A data quality check flagged the following issue in a daily OHLCV dataset:'
)
PROMPT_HISTORY = (
    'Here is the surrounding trading-day price/volume history for this ticker '
    '(roughly 10 trading days before and after the flagged date):'
)
PROMPT_CLOSING = (
    "Briefly consider what's most likely (a genuine market move, an unadjusted stock "
    'split or dividend, a data provider glitch, or a stale/duplicate data artifact), '
    'then state your conclusion in 2-3 sentences total. Do not address every '
    'hypothesis individually — just reach and justify your best explanation, in plain'
    ' prose with no markdown, bold text, bullet points, or headers.'
)

VALUES = "open, high, low, close, volume, adj_close"
#: Order among bars of one ticker and day, as the checks use it.
TIES = ", ".join(f"{name} NULLS FIRST" for name in VALUES.split(", "))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def number(value: str, decimals: int) -> str:
    return (
        f"CASE WHEN {value} IS NULL OR isnan({value}) THEN 'nan' "
        f"ELSE printf('%.{decimals}f', {value}) END"
    )


# --- bars -----------------------------------------------------------------------------------

HOLIDAYS = """
holidays AS (
    SELECT * FROM (VALUES ('NYSE', DATE '2024-01-01'), ('NYSE', DATE '2024-01-15'),
                          ('LSE', DATE '2024-01-01')) AS h(exchange, date)
)"""

BARS = f"""{HOLIDAYS},
daily AS (
    SELECT user_id, CAST(ts AS DATE) AS date,
           min_by(value, event_id) AS first_value, max_by(value, event_id) AS last_value,
           min(value) AS least, max(value) AS most, count(*) AS n
    FROM events
    GROUP BY ALL
),
bars AS (
    SELECT 'U' || user_id AS ticker,
           CASE WHEN user_id % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange,
           date,
           first_value AS open,
           CASE WHEN (user_id * 7 + day(date)) % 41 = 0 THEN least - 1 ELSE most END AS high,
           least AS low,
           CASE WHEN user_id % 10 = 3 AND day(date) BETWEEN 8 AND 12
                THEN 50.0::DOUBLE ELSE last_value END AS close,
           n * 100 AS volume,
           last_value AS adj_close
    FROM daily
)"""

REPEATING = f"""{BARS},
repeating AS (
    SELECT * FROM bars
    UNION ALL
    SELECT * FROM bars WHERE (CAST(substr(ticker, 2) AS BIGINT) * 3 + day(date)) % 53 = 0
)"""

TICKS = f"""{HOLIDAYS},
ticks AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS price,
           CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem
)"""

SUPPLIERS = f"""{TICKS},
bars AS (
    SELECT 'S' || l_suppkey AS ticker,
           CASE WHEN l_suppkey % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange,
           date, min(price) AS open, max(price) AS high, min(price) AS low, max(price) AS close,
           CAST(sum(quantity) AS BIGINT) AS volume, max(price) AS adj_close
    FROM ticks
    GROUP BY l_suppkey, date
)"""

TICK_BARS = f"""{TICKS},
bars AS (
    SELECT 'S' || l_suppkey AS ticker,
           CASE WHEN l_suppkey % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange,
           date, price AS open, price AS high,
           CASE WHEN quantity = 13 THEN price + 1 ELSE floor(price / 100) * 100 END AS low,
           floor(price / 100) * 100 AS close, quantity AS volume, price AS adj_close
    FROM ticks
)"""

LANDED = """
landed AS (
    SELECT 'U' || user_id AS symbol, ts, value AS open, value + 1 AS high, value - 1 AS low,
           CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS close, value * 50 AS volume
    FROM events
),
universe AS (
    SELECT 'U' || c_custkey AS symbol,
           CASE WHEN c_custkey % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange
    FROM customer
),
normalized AS (
    SELECT symbol AS ticker, exchange,
           CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE
                CASE exchange WHEN 'NYSE' THEN 'America/New_York' ELSE 'Europe/London' END
                AS DATE) AS date,
           open, high, low, close, CAST(volume AS BIGINT) AS volume,
           CAST(NULL AS DOUBLE) AS adj_close
    FROM landed JOIN universe USING (symbol)
)"""


# --- checks: each reads ``source`` and yields (ticker, date, flag_type, severity, details) ----


def missing_dates(source: str) -> str:
    return f"""
    SELECT b.ticker, d.date, 'MISSING_DATES' AS flag_type, 'low' AS severity,
           'No price row found for expected trading day ' || d.date || '.' AS details
    FROM (SELECT ticker, min(exchange) AS exchange, min(date) AS lo, max(date) AS hi
          FROM {source} GROUP BY ticker) b,
         LATERAL (SELECT CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS date) d
    WHERE isodow(d.date) <= 5
      AND NOT EXISTS (SELECT 1 FROM holidays h WHERE h.exchange = b.exchange AND h.date = d.date)
      AND NOT EXISTS (SELECT 1 FROM {source} p WHERE p.ticker = b.ticker AND p.date = d.date)"""


def numbered(source: str) -> str:
    """Rows with their place in the ticker's series, fixed once even among exact copies."""
    return (
        f"(SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date, {TIES}) AS place "
        f"FROM {source})"
    )


def stale_price(source: str, n: int = 3) -> str:
    return f"""
    SELECT ticker, date, 'STALE_PRICE' AS flag_type, 'medium' AS severity,
           'close unchanged at ' || {number('close', 2)} || ' for ' || streak_length
               || ' consecutive trading days' AS details
    FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker, streak ORDER BY place) AS streak_length
        FROM (
            SELECT *, sum(CASE WHEN previous IS NULL OR close <> previous THEN 1 ELSE 0 END)
                          OVER (PARTITION BY ticker ORDER BY place ROWS UNBOUNDED PRECEDING) AS streak
            FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY place) AS previous
                  FROM {numbered(source)})
        )
    )
    WHERE streak_length > {n}"""


def outlier_return(source: str, k: float = 3.0) -> str:
    return f"""
    SELECT ticker, date, 'OUTLIER_RETURN' AS flag_type, 'medium' AS severity,
           'daily return ' || {number('ret', 2)} || '% vs trailing 30-day mean '
               || {number('mean', 2)} || '% (std ' || {number('deviation', 2)} || '%) — '
               || {number('((ret - mean) / deviation)', 1)} || ' std devs from mean' AS details
    FROM (
        SELECT *, avg(ret) OVER past AS mean, stddev_samp(ret) OVER past AS deviation
        FROM (SELECT *, (adj_close / lag(adj_close) OVER (PARTITION BY ticker ORDER BY place) - 1)
                        * 100 AS ret
              FROM {numbered(source)})
        WINDOW past AS (PARTITION BY ticker ORDER BY place ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
    )
    WHERE deviation > 0 AND abs(ret - mean) > {k} * deviation"""


def duplicate_rows(source: str) -> str:
    return f"""
    SELECT ticker, date, 'DUPLICATE_ROW' AS flag_type, 'high' AS severity,
           count(*) || ' duplicate rows found for this ticker/date combination' AS details
    FROM {source}
    GROUP BY ticker, date
    HAVING count(*) > 1"""


def ohlc_inconsistency(source: str) -> str:
    rules = [
        ("high", "<", "low"),
        ("high", "<", "open"),
        ("high", "<", "close"),
        ("low", ">", "open"),
        ("low", ">", "close"),
    ]
    texts = ", ".join(
        f"CASE WHEN {a} {sign} {b} THEN '{a} (' || {number(a, 2)} || ') {sign} {b} (' "
        f"|| {number(b, 2)} || ')' END"
        for a, sign, b in rules
    )
    return f"""
    SELECT ticker, date, 'OHLC_INCONSISTENCY' AS flag_type, 'high' AS severity,
           concat_ws('; ', {texts}) AS details
    FROM {source}
    WHERE {' OR '.join(' '.join(rule) for rule in rules)}"""


def all_flags(source: str) -> str:
    return " UNION ALL ".join(
        f"({check(source)})"
        for check in (missing_dates, stale_price, outlier_return, duplicate_rows, ohlc_inconsistency)
    )


FLAGS = f"""{BARS},
flags AS MATERIALIZED ({all_flags('bars')})"""

STORED = f"""{FLAGS},
stored AS (
    SELECT ticker, date, flag_type, 'Seen before: ' || flag_type AS explanation
    FROM flags WHERE day(date) % 3 = 0
),
pending AS (
    SELECT f.* FROM flags f
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.ticker = f.ticker AND s.date = f.date
                                               AND s.flag_type = f.flag_type)
)"""


# --- price windows, prompts, explanations -----------------------------------------------------


def price_window(targets: str, span: int) -> str:
    return f"""
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date, {TIES}) AS rn FROM bars
),
anchors AS (
    SELECT r.ticker, r.date, r.rn FROM ranked r
    JOIN (SELECT DISTINCT ticker, date FROM {targets}) t USING (ticker, date)
),
windows AS (
    SELECT a.ticker, a.date AS target_date, r.date, r.open, r.high, r.low, r.close, r.volume,
           r.adj_close
    FROM (SELECT *, unnest(range(rn - {span}, rn + {span} + 1)) AS place FROM anchors) a
    JOIN ranked r ON r.ticker = a.ticker AND r.rn = a.place
)"""


HISTORY_LINE = " || ".join(
    [
        "date",
        "' 00:00:00  open='",
        number("open", 2),
        "' high='",
        number("high", 2),
        "' low='",
        number("low", 2),
        "' close='",
        number("close", 2),
        "' volume='",
        "coalesce(CAST(volume AS VARCHAR), 'NA')",
        "' adj_close='",
        number("adj_close", 2),
    ]
)

PROMPTS = f"""{STORED},
{price_window('pending', 10)},
histories AS (
    SELECT ticker, target_date, string_agg({HISTORY_LINE}, chr(10) ORDER BY date) AS history
    FROM windows GROUP BY ticker, target_date
),
prompts AS (
    SELECT p.*,
           {quoted(PROMPT_OPENING)} || chr(10) || chr(10) || 'Ticker: ' || p.ticker
           || chr(10) || 'Date: ' || coalesce(p.date || ' 00:00:00', 'NaT')
           || chr(10) || 'Flag type: ' || p.flag_type
           || chr(10) || 'Severity: ' || p.severity
           || chr(10) || 'Description: ' || p.details
           || chr(10) || chr(10) || {quoted(PROMPT_HISTORY)} || chr(10) || chr(10)
           || coalesce(h.history, '')
           || chr(10) || chr(10) || {quoted(PROMPT_CLOSING)} AS prompt
    FROM pending p LEFT JOIN histories h ON h.ticker = p.ticker AND h.target_date = p.date
)"""

RESULTS = f"""{PROMPTS},
results AS (
    SELECT ticker, date, flag_type,
           CASE WHEN severity <> 'high' THEN
               length(prompt) || ' characters, '
               || ((length(prompt) - length(replace(prompt, 'adj_close=', ''))) // 10) || ' bars'
           END AS explanation,
           CASE WHEN severity = 'high' THEN 'failed' ELSE 'explained' END AS status,
           CASE WHEN severity = 'high' THEN 'RuntimeError: no answer' END AS error
    FROM prompts
)"""


# --- report -----------------------------------------------------------------------------------

ENTRIES = f"""{STORED},
entries AS (
    SELECT f.ticker, f.date, f.flag_type, f.severity, f.details,
           coalesce(s.explanation,
                    CASE f.flag_type WHEN 'MISSING_DATES' THEN 'Excluded: known market holiday'
                                     ELSE 'No explanation available' END) AS explanation
    FROM flags f
    LEFT JOIN stored s ON s.ticker = f.ticker AND s.date = f.date AND s.flag_type = f.flag_type
    WHERE f.ticker IN (SELECT ticker FROM bars)
)"""

RATE = """
rate AS (
    SELECT total_rows, flagged_rows,
           CASE WHEN total_rows = 0 THEN 0.0::DOUBLE
                ELSE 100.0::DOUBLE * (total_rows - flagged_rows) / total_rows END AS pass_rate,
           CASE WHEN total_rows = 0 THEN 0.0::DOUBLE
                ELSE 100.0::DOUBLE * (total_rows - existing) / total_rows END AS pass_rate_existing
    FROM (SELECT (SELECT count(*) FROM bars) AS total_rows,
                 (SELECT count(*) FROM (SELECT DISTINCT ticker, date FROM flags)) AS flagged_rows,
                 (SELECT count(*) FROM bars b WHERE EXISTS (
                     SELECT 1 FROM flags f WHERE f.ticker = b.ticker AND f.date = b.date)) AS existing)
)"""

SCOPE_HASH = """
    SELECT substr(sha256((SELECT count(*) || ',' || sum(CAST('0x' || substr(sha256(ticker), 1, 15) AS BIGINT))
                          FROM (SELECT DISTINCT ticker FROM bars))
                         || '|' || min(date) || '|' || max(date)), 1, 8) AS scope_hash
    FROM bars"""


def text_row(section: int, text: str, source: str, **keys: str) -> str:
    types = {
        "ticker": "VARCHAR",
        "entry": "INTEGER",
        "date": "DATE",
        "flag_type": "VARCHAR",
        "severity": "VARCHAR",
        "place": "VARCHAR",
    }
    columns = ", ".join(
        f"CAST({keys.get(name, 'NULL')} AS {kind}) AS {name}" for name, kind in types.items()
    )
    return f"(SELECT CAST({section} AS INTEGER) AS section, {columns}, {text} AS text FROM {source})"


REPORT = " UNION ALL ".join(
    [
        text_row(
            0,
            "'# Data Quality Report' || chr(10) || chr(10) || '## Summary' || chr(10) || chr(10)"
            " || '- Date range: ' || min(date) || ' to ' || max(date)",
            "bars",
        ),
        text_row(
            1,
            "CASE WHEN ticker = (SELECT min(ticker) FROM bars) THEN '- Tickers: ' ELSE '  ' END || ticker"
            " || CASE WHEN ticker = (SELECT max(ticker) FROM bars) THEN '' ELSE ',' END",
            "(SELECT DISTINCT ticker FROM bars)",
            ticker="ticker",
        ),
        text_row(2, "'- Total rows: ' || count(*) || chr(10)", "bars"),
        text_row(
            3,
            "CASE WHEN count(*) = 0 THEN 'No flags recorded.' ELSE "
            "'| Flag Type | Severity | Count |' || chr(10) || '|---|---|---|' END",
            "flags",
            entry="0",
        ),
        text_row(
            3,
            "'| ' || flag_type || ' | ' || severity || ' | ' || n || ' |'",
            "(SELECT flag_type, severity, count(*) AS n FROM flags GROUP BY ALL)",
            entry="1",
            flag_type="flag_type",
            severity="severity",
        ),
        text_row(4, "''", "(SELECT 1)"),
        text_row(
            5,
            "'## ' || ticker || chr(10)",
            "(SELECT DISTINCT ticker FROM bars)",
            ticker="ticker",
            entry="0",
        ),
        text_row(
            5,
            "'No flags for this ticker.' || chr(10)",
            "(SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (SELECT ticker FROM flags))",
            ticker="ticker",
            entry="1",
        ),
        text_row(
            5,
            "'### ' || date || ' — ' || flag_type || ' (' || severity || ')' || chr(10)"
            " || '- Details: ' || details || chr(10) || '- Explanation: ' || explanation || chr(10)",
            "entries",
            ticker="ticker",
            entry="1",
            date="date",
            flag_type="flag_type",
            severity="severity",
            place="details || chr(10) || explanation",
        ),
        text_row(
            6,
            "'## Result' || chr(10) || chr(10) || printf('%.1f', pass_rate)"
            " || '% of rows passed all validation checks.'",
            "rate",
        ),
    ]
)


# --- jobs over stored tables ------------------------------------------------------------------

CONFIGURED = """
universe AS (
    SELECT 'U' || c_custkey AS symbol, CASE WHEN c_custkey % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange
    FROM customer
)"""

#: The bars of configured tickers take the place of all bars.
CONFIGURED_BARS = BARS.replace("\nbars AS (", "\nevery_bar AS (") + f""",{CONFIGURED},
bars AS (SELECT * FROM every_bar WHERE ticker IN (SELECT symbol FROM universe))"""

#: All flags of configured tickers, none explained before.
FIRST_RUN = RESULTS.replace(BARS, CONFIGURED_BARS).replace("FROM flags WHERE day(date) % 3 = 0", "FROM flags WHERE false")

COMPARISON_SQL = {
    "bars": f"WITH {BARS} SELECT * FROM bars",
    "supplier_bars": f"WITH {SUPPLIERS} SELECT * FROM bars",
    "normalize_bars": f"WITH {LANDED} SELECT * FROM normalized",
    "recent_bars": f"""WITH {LANDED} SELECT * FROM normalized
        QUALIFY date >= max(date) OVER (PARTITION BY ticker) - 4""",
    "missing_tickers": f"""WITH {LANDED} SELECT symbol, exchange FROM universe
        WHERE symbol NOT IN (SELECT symbol FROM landed)""",
    "repeated_keys": f"""WITH {REPEATING} SELECT ticker, date, count(*) AS count FROM repeating
        GROUP BY ticker, date HAVING count(*) > 1""",
    "upsert_prices": f"""WITH {BARS},
        corrected AS (SELECT ticker, exchange, date, open, high, low, close + 1 AS close, volume,
                             adj_close + 1 AS adj_close
                      FROM bars WHERE day(date) >= 20),
        batch AS (SELECT * FROM corrected UNION ALL
                  SELECT 'N' || ticker AS ticker, * EXCLUDE (ticker) FROM corrected)
        SELECT * FROM bars b WHERE NOT EXISTS (
            SELECT 1 FROM batch n WHERE n.ticker = b.ticker AND n.date = b.date)
        UNION ALL SELECT * FROM batch""",
    "ingest_counts": f"WITH {BARS} SELECT count(*) AS rows, count(DISTINCT ticker) AS tickers FROM bars",
    "ticker_summary": f"""WITH {BARS} SELECT ticker, count(*) AS rows, min(date) AS start_date,
        max(date) AS end_date FROM bars GROUP BY ticker ORDER BY ticker""",
    "ticker_bounds": f"""WITH {BARS} SELECT ticker, any_value(exchange) AS exchange,
        min(date) AS min_date, max(date) AS max_date FROM bars GROUP BY ticker""",
    "tickers": f"WITH {BARS} SELECT DISTINCT ticker FROM bars ORDER BY ticker",
    "scope_stats": f"""WITH {BARS} SELECT min(date) AS min_date, max(date) AS max_date,
        count(*) AS total_rows FROM bars""",
    "scope_hash": f"WITH {BARS} {SCOPE_HASH}",
    "report_name": f"""WITH {BARS}, hashed AS ({SCOPE_HASH})
        SELECT 'market_data_quality_report_2026-12-25_' || scope_hash || '.md' AS report_name
        FROM hashed""",
    "missing_dates": f"WITH {BARS} {missing_dates('bars')}",
    "stale_price": f"WITH {BARS} {stale_price('bars')}",
    "outlier_return": f"WITH {BARS} {outlier_return('bars')}",
    "duplicate_rows": f"WITH {REPEATING} {duplicate_rows('repeating')}",
    "ohlc_inconsistency": f"WITH {BARS} {ohlc_inconsistency('bars')}",
    "all_flags": f"WITH {BARS} {all_flags('bars')}",
    "supplier_missing_dates": f"WITH {SUPPLIERS} {missing_dates('bars')}",
    "supplier_outlier_return": f"WITH {SUPPLIERS} {outlier_return('bars', 2.0)}",
    "unkeyed_all_flags": f"WITH {TICK_BARS} {all_flags('bars')}",
    "cut_all_flags": f"WITH {TICK_BARS} {all_flags('bars')}",
    "flag_counts": f"""WITH {FLAGS} SELECT flag_type, severity, count(*) AS count FROM flags
        GROUP BY ALL ORDER BY ALL""",
    "flagged_pairs": f"WITH {FLAGS} SELECT DISTINCT ticker, date FROM flags",
    "pass_rate": f"WITH {FLAGS}, {RATE} SELECT * FROM rate",
    "unexplained_flags": f"WITH {STORED} SELECT * FROM pending",
    "flags_with_explanations": f"""WITH {STORED}
        SELECT f.*, s.explanation FROM flags f LEFT JOIN stored s
        ON s.ticker = f.ticker AND s.date = f.date AND s.flag_type = f.flag_type""",
    "price_window": f"WITH {FLAGS}, {price_window('flags', 10)} SELECT * FROM windows",
    "cut_price_window": f"""WITH {TICK_BARS}, broken AS ({ohlc_inconsistency('bars')}),
        {price_window('broken', 3)} SELECT * FROM windows""",
    "prompts": f"WITH {PROMPTS} SELECT * FROM prompts",
    "explain_batch": f"WITH {RESULTS} SELECT * FROM results",
    "explain_counts": f"""WITH {RESULTS}
        SELECT count(*) FILTER (WHERE status = 'explained') AS newly_explained,
               (SELECT count(*) FROM flags) - count(*) AS already_cached,
               count(*) FILTER (WHERE status = 'failed') AS failed
        FROM results""",
    "report_entries": f"WITH {ENTRIES} SELECT * FROM entries",
    "report_lines": f"WITH {ENTRIES}, {RATE} {REPORT}",
    "stored_universe": f"WITH {CONFIGURED} SELECT * FROM universe",
    "stored_ingest": f"""WITH {CONFIGURED_BARS} SELECT * FROM bars
        QUALIFY date >= CAST(max(date) OVER (PARTITION BY ticker) - INTERVAL 1 MONTH AS DATE)""",
    "stored_rejects": f"""WITH {CONFIGURED_BARS}
        SELECT ticker, 'Close is much' AS reason, count(*) FILTER (WHERE day(date) = 13) AS rows,
               count(*) FILTER (WHERE day(date) <> 13) AS ingested
        FROM bars GROUP BY ticker HAVING rows > 0 AND ingested > 0""",
    "stored_flags": f"WITH {FLAGS} SELECT * FROM flags",
    "stored_explanations": f"""WITH {STORED} SELECT * FROM stored UNION ALL
        SELECT ticker, date, flag_type, explanation || ' again' FROM stored""",
    "stored_explained": f"""WITH {RESULTS}
        SELECT *, CAST(NULL AS VARCHAR) AS error FROM stored UNION ALL
        SELECT ticker, date, flag_type, explanation, error FROM results""",
    "stored_report": f"""WITH {ENTRIES}, {RATE},
        hashed AS ({SCOPE_HASH}), report AS ({REPORT}),
        split AS (SELECT unnest(string_split(text, chr(10))) AS value FROM report)
        SELECT value, count(*) AS lines,
               (SELECT 'market_data_quality_report_2026-12-25_' || scope_hash || '.md' FROM hashed) AS report_name
        FROM split GROUP BY value""",
    "stored_pipeline": f"""WITH {FIRST_RUN}
        SELECT f.*, r.explanation FROM flags f
        LEFT JOIN results r ON r.ticker = f.ticker AND r.date = f.date AND r.flag_type = f.flag_type""",
    "flag_shares": f"""WITH {FLAGS}
        SELECT ticker, date, flag_type, count(*) OVER (PARTITION BY flag_type, severity) AS of_kind FROM flags""",
    "no_flags": f"WITH {FLAGS} SELECT * FROM flags WHERE false",
}
COMPARISON_SQL["stored_upsert"] = COMPARISON_SQL["upsert_prices"]
