"""DuckDB SQL building blocks for the correctness oracle.

The fixture CTEs are the published derivations; the cleaning and feature CTEs
restate the operators' definitions in plain SQL.
"""

from __future__ import annotations

CANDLES = """candles AS (
  WITH e AS (
    SELECT concat('U', cast(user_id AS varchar), '-', event_type) AS market_id, date_trunc('hour', ts) AS ds, ts, value,
           cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k, user_id, event_type FROM events),
  b AS (
    SELECT market_id, ds, max_by(least(value/100, 1.0), ts) AS close, max(least(value/100, 1.0)) AS high,
           min(least(value/100, 1.0)) AS low, avg(least(value/100, 1.0)) AS mean_px, sum(value) AS volume,
           max_by(k, ts) AS k, max(user_id) AS user_id, max(event_type) AS event_type
    FROM e GROUP BY market_id, ds),
  l AS (SELECT market_id, round(avg(close), 6) AS ac FROM b GROUP BY market_id)
  SELECT b.market_id, b.ds, b.close, b.high, b.low,
    cast(CASE WHEN b.event_type = 'signup' AND b.user_id % 10 = 0 THEN NULL WHEN l.ac >= 0.45 THEN 1 ELSE 0 END AS double) AS label,
    b.volume, cast(b.k AS double) AS open_interest,
    CASE WHEN b.k % 13 = 0 THEN NULL ELSE b.close END AS ask_close, b.high AS ask_high, b.low AS ask_low,
    CASE WHEN b.k % 7 = 0 THEN NULL ELSE greatest(b.close - 0.01*(1 + b.k % 5), 0.0) END AS bid_close,
    b.high*0.9 AS bid_high, b.low*0.9 AS bid_low,
    CASE WHEN b.k % 11 = 0 THEN NULL ELSE b.mean_px END AS price_mean
  FROM b JOIN l ON b.market_id = l.market_id)"""

FLAT = """flat AS (
  SELECT market_id, regexp_replace(market_id, '-[^-]*$', '') AS series_id, ds, close, high, low, label, volume,
         open_interest, cast(epoch(ds) AS bigint) AS end_period_ts, ask_close, ask_high, ask_low,
         bid_close, bid_high, bid_low, price_mean
  FROM candles)"""

RAW_MARKETS = """raw_markets AS (
  WITH o AS (SELECT o_orderkey AS k, o_custkey AS cu, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS tp, o_orderdate AS od FROM orders),
  s AS (SELECT 0 AS src, k, cu, st, pr, tp, od FROM o WHERE k % 3 <> 0
        UNION ALL SELECT 1 AS src, k, cu, st, pr, tp, od FROM o WHERE k % 2 = 0)
  SELECT src, k AS seq, concat('O', cast(k // 160 AS varchar), '-', cast(k // 4 AS varchar)) AS ticker, concat('O', cast(k // 160 AS varchar)) AS event_ticker,
    CASE st WHEN 'F' THEN 'finalized' WHEN 'P' THEN 'closed' ELSE 'active' END AS status,
    CASE WHEN k % 17 = 0 THEN 'scalar' ELSE 'binary' END AS market_type,
    CASE WHEN k % 19 = 0 THEN concat('MVE', cast(cu AS varchar)) WHEN k % 2 = 0 THEN '' ELSE NULL END AS mve_collection_ticker,
    CASE WHEN k % 23 = 0 THEN '' WHEN tp > 250000 THEN 'yes' ELSE 'no' END AS result,
    CASE WHEN k % 4 = 0 THEN '  ' WHEN k % 4 = 1 THEN NULL ELSE concat(' If ', pr, ' ships then Yes ') END AS rules_primary,
    CASE WHEN k % 5 = 0 THEN pr ELSE '' END AS yes_sub_title, CASE WHEN k % 7 = 0 THEN pr END AS no_sub_title,
    CASE WHEN k % 11 = 0 THEN concat('assoc ', pr) END AS associated_markets, concat('title ', pr) AS title,
    od AS open_time,
    CASE WHEN k % 6 = 0 THEN NULL WHEN cu % 10 = 0 THEN od + INTERVAL '30' MINUTE
         WHEN cu % 10 = 1 THEN od - INTERVAL '1' HOUR ELSE od + INTERVAL '48' HOUR END AS close_time,
    CASE WHEN k % 12 = 0 THEN od + INTERVAL '5' HOUR END AS settlement_ts,
    cast(cast(tp / 500000.0 AS decimal(10,4)) AS varchar) AS yes_ask_dollars,
    cast(cast(1 - tp / 500000.0 AS decimal(10,4)) AS varchar) AS no_ask_dollars,
    cast(cast(tp / 510000.0 AS decimal(10,4)) AS varchar) AS last_price_dollars,
    CASE WHEN k % 29 = 0 THEN '' ELSE cast(k AS varchar) END AS volume_fp
  FROM s)"""

FLAT_COLS = ("market_id, series_id, ds, close, high, low, label, volume, open_interest, end_period_ts, "
             "ask_close, ask_high, ask_low, bid_close, bid_high, bid_low, price_mean")

W = "PARTITION BY market_id ORDER BY ds"
WA = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def _prev(k: int) -> str:
    return f"({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"


TRIMMED = f"""trimmed AS (
  SELECT {FLAT_COLS} FROM (
    SELECT *, row_number() OVER ({W}) AS _rn, count(*) OVER (PARTITION BY market_id) AS _n FROM flat)
  WHERE _rn < _n)"""


def clipped_cte(name: str, src: str, clip: bool = True, flags: bool = True) -> str:
    """C4 / C5 / C6 over ``src``."""
    if clip:
        vol = "CASE WHEN t.volume IS NULL THEN NULL WHEN q.qv IS NULL THEN t.volume ELSE least(t.volume, q.qv) END"
        oi = ("CASE WHEN t.open_interest IS NULL THEN NULL WHEN q.qo IS NULL THEN t.open_interest "
              "ELSE least(t.open_interest, q.qo) END")
        join = (f" JOIN (SELECT market_id, quantile_cont(volume, 0.99) AS qv, quantile_cont(open_interest, 0.99) AS qo "
                f"FROM {src} GROUP BY market_id) q ON t.market_id = q.market_id")
    else:
        vol, oi, join = "t.volume", "t.open_interest", ""
    if flags:
        fl = ("cast(t.price_mean IS NULL AS integer) AS price_mean_missing, cast(t.bid_close IS NULL AS integer) AS bid_close_missing, "
              "cast(t.ask_close IS NULL AS integer) AS ask_close_missing")
    else:
        fl = "0 AS price_mean_missing, 0 AS bid_close_missing, 0 AS ask_close_missing"
    return f"""{name} AS (
  SELECT t.market_id, t.series_id, t.ds, t.close, t.high, t.low, t.label, {vol} AS volume, {oi} AS open_interest,
         t.end_period_ts, t.ask_close, t.ask_high, t.ask_low, t.bid_close, t.bid_high, t.bid_low, t.price_mean, {fl}
  FROM {src} t{join})"""


PRE = clipped_cte("pre", "trimmed")


def features_cte(name: str, src: str) -> str:
    """F1-F9 over ``src`` (two CTEs: ``{name}_a`` then ``{name}``)."""
    return f"""{name}_a AS (
  SELECT *, ask_close - bid_close AS bid_ask_spread, (ask_close + bid_close) / 2 AS midpoint FROM {src}),
{name}_b AS (
  SELECT *,
    close - midpoint AS close_vs_mid, high - low AS price_range, ask_high - ask_low AS ask_range,
    bid_high - bid_low AS bid_range, close - price_mean AS close_vs_mean,
    lag(close, 1) OVER ({W}) AS close_lag1, lag(close, 2) OVER ({W}) AS close_lag2,
    close - lag(close, 1) OVER ({W}) AS momentum_1h, close - lag(close, 2) OVER ({W}) AS momentum_2h,
    ask_close - lag(ask_close, 1) OVER ({W}) AS ask_momentum, bid_close - lag(bid_close, 1) OVER ({W}) AS bid_momentum,
    bid_ask_spread - lag(bid_ask_spread, 1) OVER ({W}) AS spread_change,
    volume - lag(volume, 1) OVER ({W}) AS volume_delta, open_interest - lag(open_interest, 1) OVER ({W}) AS oi_delta,
    volume / (open_interest + 1e-6) AS vol_to_oi, ln(1 + volume) AS log_volume, ln(1 + open_interest) AS log_oi,
    max(ds) OVER (PARTITION BY market_id) AS market_end_ts,
    (epoch(max(ds) OVER (PARTITION BY market_id)) - epoch(ds)) / 3600.0 AS hours_to_expiry,
    row_number() OVER ({W}) - 1 AS hour_index,
    avg(close) OVER {_prev(2)} AS close_roll_mean_2h, stddev_samp(close) OVER {_prev(2)} AS close_roll_std_2h,
    sum(volume) OVER {_prev(2)} AS vol_roll_sum_2h,
    avg(close) OVER {_prev(3)} AS close_roll_mean_3h, stddev_samp(close) OVER {_prev(3)} AS close_roll_std_3h,
    sum(volume) OVER {_prev(3)} AS vol_roll_sum_3h,
    cast(coalesce(close <= 0.01, false) AS integer) AS close_is_floor,
    cast(coalesce(close >= 0.99, false) AS integer) AS close_is_ceiling,
    first_value(close IGNORE NULLS) OVER {WA} AS first_close,
    stddev_samp(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_std
  FROM {name}_a),
{name} AS (
  SELECT *, cast(coalesce(hours_to_expiry <= 3, false) AS integer) AS is_final_3h,
         cast(coalesce(hours_to_expiry <= 1, false) AS integer) AS is_final_1h,
         close - first_close AS close_vs_open
  FROM {name}_b)"""


FEAT = features_cte("feat", "pre")
MODEL = """model AS (SELECT * FROM feat WHERE hours_to_expiry > 6 AND label IS NOT NULL)"""
SCORED = """scored AS (
  SELECT *, least(greatest(0.6 * coalesce(ask_close, close) + 0.4 * coalesce(price_mean, close), 0.01), 0.99) AS prob
  FROM model)"""

CHAIN = {
    "candles": [CANDLES],
    "flat": [CANDLES, FLAT],
    "trimmed": [CANDLES, FLAT, TRIMMED],
    "pre": [CANDLES, FLAT, TRIMMED, PRE],
    "feat": [CANDLES, FLAT, TRIMMED, PRE, FEAT],
    "model": [CANDLES, FLAT, TRIMMED, PRE, FEAT, MODEL],
    "scored": [CANDLES, FLAT, TRIMMED, PRE, FEAT, MODEL, SCORED],
    "raw_markets": [RAW_MARKETS],
}


def with_ctes(upto, *extra: str) -> str:
    """``WITH`` clause of the named chain plus extra CTEs (pass '' to start from raw tables)."""
    parts = list(CHAIN[upto]) if upto else []
    parts += [e for e in extra if e]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def _split_top(spec: str) -> list[str]:
    """Split on commas outside parentheses, brackets and quotes."""
    out, depth, quote, cur = [], 0, None, []
    for ch in spec:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    out.append("".join(cur).strip())
    return [x for x in out if x]


def final_select(spec: str, src: str, where: str = "") -> str:
    """Normalised projection: ``name:kind[=expr]`` items; kinds d (double, 6 dp), i (bigint),
    t (timestamp text), s (string), b (boolean)."""
    items = []
    for raw in _split_top(spec.replace("\n", " ")):
        head, _, expr = raw.partition("=")
        name, _, kind = head.strip().partition(":")
        expr = expr.strip() or name
        kind = kind or "s"
        if kind == "d":
            items.append(f"round(cast({expr} AS double), 6) + 0.0 AS {name}")
        elif kind == "i":
            items.append(f"cast({expr} AS bigint) AS {name}")
        elif kind == "t":
            items.append(f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}")
        elif kind == "a":
            items.append(f"{expr} AS {name}")
        elif kind == "b":
            items.append(f"cast({expr} AS boolean) AS {name}")
        else:
            items.append(f"cast({expr} AS varchar) AS {name}")
    sql = "SELECT " + ", ".join(items) + f" FROM {src}"
    return sql + (f" WHERE {where}" if where else "")


DEDUP = """dedup AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY src DESC, seq DESC) AS _rn,
           first_value(src) OVER (PARTITION BY ticker ORDER BY src, seq) AS first_src,
           first_value(seq) OVER (PARTITION BY ticker ORDER BY src, seq) AS first_seq
    FROM raw_markets) WHERE _rn = 1)"""

QUESTION = ("coalesce(nullif(regexp_replace(rules_primary, '^\\s+|\\s+$', '', 'g'), ''), nullif(yes_sub_title, ''), "
            "nullif(no_sub_title, ''), nullif(associated_markets, ''), title)")

QDEDUP = f"""qd AS (
  SELECT *, {QUESTION} AS question,
    coalesce(status IN ('closed', 'determined', 'settled', 'finalized') AND market_type = 'binary'
             AND coalesce(mve_collection_ticker, '') = '' AND result IN ('yes', 'no'), false) AS valid,
    coalesce(regexp_matches(lower({QUESTION}), '\\b(?:urgent|high|not specified)\\b'), false) AS kw
  FROM dedup)"""

SAMPLES = """samples AS (
  SELECT ticker AS market_id, try_cast(yes_ask_dollars AS double) AS yes_price, try_cast(no_ask_dollars AS double) AS no_price,
    try_cast(last_price_dollars AS double) AS last_price_dollars,
    [CASE WHEN volume_fp IS NULL OR volume_fp = '' THEN 0.0 ELSE try_cast(volume_fp AS double) END] AS volume_history,
    CAST(NULL AS double) AS price_momentum, CAST(NULL AS double) AS volume_weighted_price, 0.0 AS time_to_resolution,
    question AS rag_query, CASE WHEN result = 'yes' THEN 1.0 ELSE 0.0 END AS label
  FROM qd WHERE valid AND kw)"""

MARKET_AGG = """mm AS (
  SELECT market_id, series_id, min(ds) AS first_ds, max(ds) AS last_ds, max(label) AS label,
         cast(regexp_extract(market_id, '^U([0-9]+)', 1) AS int) AS uid
  FROM flat GROUP BY market_id, series_id)"""

LIFE = """lw AS (
  SELECT ticker, s AS start_ts, e AS end_ts,
    CASE WHEN s IS NULL OR e IS NULL THEN 'missing timestamps' WHEN e <= s THEN 'end <= start'
         WHEN e - s < 3600 THEN 'window < 1 hour' END AS skip_reason
  FROM (SELECT market_id AS ticker,
          CASE WHEN uid % 11 = 0 THEN NULL ELSE cast(epoch(first_ds) AS bigint) - 3600 END AS s,
          CASE WHEN uid % 7 = 0 THEN (CASE WHEN uid % 2 = 0 THEN cast(epoch(last_ds) AS bigint) END)
               WHEN uid % 5 = 0 THEN cast(epoch(first_ds) AS bigint) - 1800
               ELSE cast(epoch(last_ds) AS bigint) - 86400 END AS e
        FROM mm))"""

CHAIN["dedup"] = [RAW_MARKETS, DEDUP]
CHAIN["qd"] = [RAW_MARKETS, DEDUP, QDEDUP]
CHAIN["samples"] = [RAW_MARKETS, DEDUP, QDEDUP, SAMPLES]
CHAIN["life"] = [CANDLES, FLAT, MARKET_AGG, LIFE]

SPLIT = """grp AS (SELECT series_id, md5(concat('42:', series_id)) AS h FROM (SELECT DISTINCT series_id FROM model)),
rk AS (SELECT series_id, row_number() OVER (ORDER BY h, series_id) - 1 AS r, count(*) OVER () AS n FROM grp),
asg AS (SELECT series_id, CASE WHEN r < ceil(0.15::double * n) THEN 'test'
    WHEN r < ceil(0.15::double * n) + ceil(0.15::double / (0.7::double + 0.15::double) * (n - ceil(0.15::double * n)))
    THEN 'val' ELSE 'train' END AS split FROM rk),
splitted AS (SELECT m.*, a.split FROM model m JOIN asg a ON m.series_id = a.series_id),
scored AS (
  SELECT *, least(greatest(0.6 * coalesce(ask_close, close) + 0.4 * coalesce(price_mean, close), 0.01), 0.99) AS prob
  FROM splitted),
test AS (SELECT * FROM scored WHERE split = 'test')"""

CHAIN["split"] = [CANDLES, FLAT, TRIMMED, PRE, FEAT, MODEL, SPLIT]

EPS = "2.220446049250313e-16"


def metrics_sql(src: str, prob: str = "prob", label: str = "label") -> str:
    """One-row n / log_loss / brier / auc over ``src`` (a table name or subquery)."""
    p = f"least(greatest({prob}, {EPS}), 1 - {EPS})"
    return f"""(SELECT sum(c) AS n, sum(ll) / sum(c) AS log_loss, sum(sq) / sum(c) AS brier,
    sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM (
    SELECT {prob} AS s, count(*) AS c, sum({label}) AS pos, sum(1 - {label}) AS neg,
      sum(-({label} * ln({p}) + (1 - {label}) * ln(1 - {p}))) AS ll,
      sum(({prob} - {label}) * ({prob} - {label})) AS sq
    FROM {src} WHERE {prob} IS NOT NULL AND {label} IS NOT NULL GROUP BY {prob})))"""


def round_half_up(expr: str, digits: int) -> str:
    """Round like Spark does for doubles: half-up on the shortest decimal text of the value."""
    return (f"coalesce(cast(round(try_cast(cast({expr} AS varchar) AS decimal(38,18)), {digits}) AS double), "
            f"round({expr}, {digits}))")
