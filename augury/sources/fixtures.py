"""Inputs of the library derived from the given tables, by one SQL text for both engines.

Every value is an integer or a string, so that both engines see the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from augury.sources.dialect import DUCKDB, SPARK, Dialect

# Contract addresses and topics of the two event layouts: fixed values.
LEGACY = ("0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e", "0xc5d563a36ae78145c45a50134d48a1215220f80a")
CURRENT = (
    "0xe111180000d2663c0091e4f400237545b87b996b",
    "0xe2222d279d744050d28e00520010520000310f59",
    "0xe3333700ca9d93003f00f0f71f8515005f6c00aa",
)
LEGACY_TOPIC = "0xd0a08e8c493f9c94f29311604c9de1b4e8c8d4c06bd0c789af57f2d65bfec0f6"
CURRENT_TOPIC = "0xd543adfd945773f1a62f74f0ee55a5e3b9b1a28262980ba90b1a89f2ea84d8ee"


def _lines(d: Dialect) -> str:
    everything = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
    return f"""
        SELECT l_orderkey AS o, l_partkey, l_suppkey, l_returnflag, l_linestatus, {d.days('l_shipdate')} AS day,
            cast(l_quantity AS bigint) * 1000000 AS token_amount,
            cast(round(l_extendedprice * 100) AS bigint) % (cast(l_quantity AS bigint) * 1000000) + 1 AS usdc_amount,
            row_number() OVER (PARTITION BY l_orderkey ORDER BY {everything}) AS rn
        FROM {{lineitem}}"""


def logs(d: Dialect) -> str:
    """Event logs of fills: address, topic0..topic3, n_topics, data, tx_hash, log_index, block_number."""
    w = d.hex64
    return f"""
        WITH l AS ({_lines(d)}),
        m AS (SELECT *, (o * 7 + rn) % 97 AS odd, o % 3 AS layout FROM l)
        SELECT CASE WHEN layout = 0 THEN CASE o % 5 WHEN 0 THEN '{CURRENT[0]}' WHEN 1 THEN '{CURRENT[1]}' ELSE '{CURRENT[2]}' END
                ELSE CASE o % 2 WHEN 0 THEN '{LEGACY[0]}' ELSE '{LEGACY[1]}' END END AS address,
            CASE WHEN odd = 3 THEN '0xff' WHEN layout = 0 THEN '{CURRENT_TOPIC}' ELSE '{LEGACY_TOPIC}' END AS topic0,
            '0x' || {w('o * 31 + rn')} AS topic1, '0x' || {w('l_suppkey + 1000')} AS topic2, '0x' || {w('l_partkey % 50 + 5000')} AS topic3,
            CASE WHEN odd = 5 THEN 3 ELSE 4 END AS n_topics,
            '0x' || CASE WHEN layout = 0 THEN
                    {w("CASE WHEN odd = 9 THEN 2 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END")} || {w('l_partkey + 1')}
                    || {w("CASE WHEN l_returnflag = 'R' THEN token_amount ELSE usdc_amount END")}
                    || {w("CASE WHEN odd = 11 THEN 0 WHEN l_returnflag = 'R' THEN usdc_amount ELSE token_amount END")} || {w('l_suppkey')}
                    || {w('o')} || {w('rn')}
                ELSE {w("CASE WHEN l_returnflag = 'R' OR odd = 13 THEN l_partkey + 1 ELSE 0 END")} || {w("CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_partkey + 1 END")}
                    || {w("CASE WHEN l_returnflag = 'R' THEN token_amount ELSE usdc_amount END")}
                    || {w("CASE WHEN odd = 11 THEN 0 WHEN l_returnflag = 'R' THEN usdc_amount ELSE token_amount END")}
                    || CASE WHEN odd = 7 THEN '' ELSE {w('l_suppkey')} END END AS data,
            '0x' || {w('o')} AS tx_hash, cast(rn AS bigint) AS log_index, (day - 7305) * 1000 + o % 1000 AS block_number
        FROM m"""


def markets(d: Dialect) -> str:
    """Markets, two parts each: market_id, condition_id, identity_kind, category, slug, and marks for classification."""
    return f"""
        SELECT {d.div('p_partkey', 2)} + 1 AS market_id, '0x' || {d.hex64(d.div('min(p_partkey)', 2) + ' + 77')} AS condition_id,
            CASE {d.div('p_partkey', 2)} % 11 WHEN 3 THEN 'legacy_placeholder' WHEN 5 THEN 'official_combo' WHEN 7 THEN 'invalid_shell' ELSE 'binary' END AS identity_kind,
            CASE {d.div('p_partkey', 2)} % 13 WHEN 4 THEN 'Ghost' WHEN 6 THEN 'sports' ELSE 'crypto' END AS category,
            CASE {d.div('p_partkey', 2)} % 17 WHEN 2 THEN 'ghost-market-' ELSE 'm-' END || cast({d.div('p_partkey', 2)} AS varchar(20)) AS slug
        FROM {{part}} GROUP BY {d.div('p_partkey', 2)}"""


def tokens(d: Dialect) -> str:
    """Tokens of markets: token_id (word), market_id, condition_id, outcome, outcome_index, active. Some are left out."""
    return f"""
        SELECT {d.hex64('p_partkey + 1')} AS token_id, {d.div('p_partkey', 2)} + 1 AS market_id,
            CASE WHEN p_partkey % 29 = 8 THEN '' ELSE upper('0x' || {d.hex64(d.div('p_partkey', 2) + ' + 77')}) END AS condition_id,
            CASE p_partkey % 2 WHEN 0 THEN 'Yes' ELSE 'No' END AS outcome,
            cast(CASE WHEN p_partkey % 37 = 9 THEN 2 ELSE p_partkey % 2 END AS int) AS outcome_index, p_partkey % 31 <> 10 AS active
        FROM {{part}} WHERE p_partkey % 19 <> 6"""


def book_events(d: Dialect) -> str:
    """Order-book events in order: pos, market, asset, kind (RESET, SNAPSHOT, CHANGE, GAP), side, price_c, size."""
    k = d.number("props")
    return f"""
        SELECT event_id AS pos, user_id AS market, event_id % 2 AS asset,
            CASE event_type WHEN 'signup' THEN CASE WHEN {k} < 10 THEN 'RESET' ELSE 'SNAPSHOT' END WHEN 'error' THEN 'GAP' ELSE 'CHANGE' END AS kind,
            CASE event_type WHEN 'click' THEN 'SELL' WHEN 'view' THEN 'BUY' ELSE CASE event_id % 3 WHEN 0 THEN 'SELL' ELSE 'BUY' END END AS side,
            {k} % 99 + 1 AS price_c, CASE WHEN event_type = 'purchase' THEN 0 ELSE cast(round(value) AS bigint) + 1 END AS size
        FROM {{events}}"""


def readiness(d: Dialect) -> str:
    """Readiness changes: plant, lane, token, ms, ready, id."""
    return f"""
        SELECT event_id % 2 AS plant, {d.div('event_id', 2)} % 2 AS lane, user_id AS token, {d.millis('ts')} AS ms,
            event_type IN ('signup', 'purchase') AS ready, event_id AS id
        FROM {{events}} WHERE event_type IN ('signup', 'purchase', 'error')"""


def probes(d: Dialect) -> str:
    """Ping and pong events of connections: id, connection, session, kind, ms."""
    return f"""
        SELECT event_id AS id, user_id AS connection, {d.div('event_id', 200)} AS session, CASE event_type WHEN 'click' THEN 'PING' ELSE 'PONG' END AS kind, {d.millis('ts')} AS ms
        FROM {{events}} WHERE event_type IN ('click', 'view')"""


def prices(d: Dialect) -> str:
    """Price records: id, asset, observed_ms, published_ms, received_ms, price (units of 1e-2), exact (same, sometimes off)."""
    ms, p = d.millis("o_orderdate"), "cast(round(o_totalprice * 100) AS bigint)"
    return f"""
        SELECT o_orderkey AS id, o_custkey % 5 AS asset, {ms} AS observed_ms, {ms} + o_orderkey % 7 AS published_ms,
            {ms} + o_orderkey % 11 AS received_ms, {p} AS price, CASE WHEN o_orderkey % 23 = 1 THEN {p} + 1 ELSE {p} END AS exact,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'other' ELSE 'feed' END AS feed
        FROM {{orders}}"""


def lifecycle(d: Dialect) -> str:
    """Oracle lifecycle events: id, market, status, block, log_index, value."""
    return f"""
        SELECT event_id AS id, user_id AS market,
            CASE event_type WHEN 'view' THEN 'request' WHEN 'click' THEN 'propose' WHEN 'error' THEN 'dispute' ELSE 'settle' END AS status,
            {d.div(d.millis('ts'), 60000)} AS block, event_id % 100 AS log_index, {d.number('props')} AS value
        FROM {{events}} WHERE event_type <> 'signup'"""


TABLES = ("lineitem", "orders", "part", "events", "customer", "supplier", "nation", "documents")


#: Fixtures that were written, by folder of the tables and name.
_WRITTEN: dict[tuple[str, str], str] = {}


def keep(spark: SparkSession, sf_dir: str, folder: str, *builds) -> dict[str, int]:
    """Write fixtures, which frame() reads from then on; returns their rows."""
    rows = {}
    for build in builds:
        df, path = frame(spark, sf_dir, build), f"{folder}/{build.__name__}"
        df.write.parquet(path)
        rows[build.__name__] = spark.read.parquet(path).count()
        _WRITTEN[sf_dir, build.__name__] = path
    return rows


def frame(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """A fixture as a DataFrame."""
    if (sf_dir, build.__name__) in _WRITTEN:
        return spark.read.parquet(_WRITTEN[sf_dir, build.__name__])
    text = build(SPARK)
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def cte(**builds) -> str:
    """Fixtures as DuckDB common table expressions: name=builder."""
    parts = []
    for name, build in builds.items():
        text = build(DUCKDB)
        for t in TABLES:
            text = text.replace(f"{{{t}}}", t)
        parts.append(f"{name} AS ({text})")
    return "WITH " + ",\n".join(parts)


def pages(d: Dialect) -> str:
    """Market catalogue rows as JSON text: id, payload. Lists come as arrays or as JSON text; some rows are broken."""
    q, b = "chr(34)", "chr(92)"
    p = "p_partkey"
    text = lambda x: f"{q} || {x} || {q}"
    quoted = lambda x: f"{b} || {q} || {x} || {b} || {q}"
    token = lambda k: f"cast({p} * 2 + {k} AS varchar(20))"
    same = f"CASE WHEN {p} % 23 = 5 THEN {token(1)} ELSE {token(2)} END"
    return f"""
        SELECT {p} AS id, CASE WHEN {p} % 41 = 7 THEN chr(123) || 'broken' ELSE chr(123) || {text("'id'")} || ':' || cast({p} AS varchar(20))
            || ',' || {text("'conditionId'")} || ':' || CASE WHEN {p} % 31 = 3 THEN 'null' WHEN {p} % 33 = 1 THEN {text(d.hex64(p + ' + 900'))} ELSE {text("'0x' || " + d.hex64(p + ' + 900'))} END
            || ',' || {text("'clobTokenIds'")} || ':' || CASE {p} % 2 WHEN 0 THEN {text("'[' || " + quoted(token(1)) + " || ',' || " + quoted(same) + " || ']'")} ELSE '[' || {text(token(1))} || ',' || {text(same)} || ']' END
            || ',' || {text("'outcomes'")} || ':' || CASE {p} % 5 WHEN 0 THEN '[' || {text("'Yes'")} || ',' || {text("'No'")} || ']' WHEN 1 THEN '[' || {text("' no '")} || ',' || {text("'YES'")} || ']'
                WHEN 2 THEN '[' || {text("'Down'")} || ',' || {text("'Up'")} || ']' WHEN 3 THEN '[' || {text("'Team   A'")} || ',' || {text("'Team B'")} || ']' ELSE CASE {p} % 3 WHEN 0 THEN '[' || {text("''")} || ',' || {text("'x'")} || ']' ELSE '[' || {text("'x'")} || ']' END END
            || ',' || {text("'outcomePrices'")} || ':' || CASE WHEN {p} % 47 = 9 THEN {text("'not json'")} WHEN {p} % 43 = 8 THEN '[' || {text("'0.5'")} || ']' ELSE '[' || {text("'0.' || cast(" + p + " % 10 AS varchar(2))")} || ',' || {text("CASE WHEN " + p + " % 19 = 2 THEN '1.5' ELSE '0.5' END")} || ']' END
            || ',' || {text("'tags'")} || ':' || CASE WHEN {p} % 15 = 7 THEN {text("'Solo  Tag'")} ELSE '[' || CASE {p} % 9 WHEN 2 THEN chr(123) || {text("'slug'")} || ':' || {text("'Tech'")} || chr(125) WHEN 5 THEN chr(123) || {text("'slug'")} || ':' || {text("''")} || ',' || {text("'label'")} || ':' || {text("'Label X'")} || chr(125) ELSE {text("p_brand")} END || ',' || {text("CASE " + p + " % 4 WHEN 0 THEN 'Sports' WHEN 1 THEN 'Crypto' ELSE 'other-things' END")} || ',' || {text("lower(p_brand)".replace('lower', 'upper'))} || ']' END
            || CASE {p} % 8 WHEN 3 THEN ',' || {text("'events'")} || ':[' || chr(123) || {text("'id'")} || ':' || {text("'e5'")} || ',' || {text("'slug'")} || ':' || {text("'ev'")} || ',' || {text("'tags'")} || ':[' || chr(123) || {text("'slug'")} || ':' || {text("'Weather'")} || chr(125) || ']'
                || CASE {p} % 3 WHEN 1 THEN ',' || {text("'categories'")} || ':[' || chr(123) || {text("'label'")} || ':' || {text("'Cat  L'")} || chr(125) || ']' ELSE '' END || chr(125) || ']' ELSE '' END
            || ',' || {text("'category'")} || ':' || CASE {p} % 6 WHEN 1 THEN {text("'  Politics '")} ELSE 'null' END
            || ',' || {text("'closed'")} || ':' || CASE {p} % 4 WHEN 0 THEN 'true' WHEN 1 THEN {text("'FALSE'")} WHEN 2 THEN '1' ELSE CASE {p} % 37 WHEN 11 THEN {text("'maybe'")} ELSE 'null' END END
            || ',' || {text("'createdAt'")} || ':' || CASE {p} % 3 WHEN 0 THEN {text("'2024-05-06T07:08:09.123456789Z'")} WHEN 1 THEN {text("'2024-05-06 07:08:09'")} ELSE CASE {p} % 29 WHEN 4 THEN {text("'soon'")} ELSE 'null' END END
            || chr(125) END AS payload
        FROM {{part}}"""


def event_pages(d: Dialect) -> str:
    """Event pages as JSON text, which nest two markets each: id, payload. Some are broken, some nest none."""
    q, p = "chr(34)", "p_partkey"
    text = lambda x: f"{q} || {x} || {q}"
    field = lambda name, value: f"{text(repr(name))} || ':' || {value}"
    listed = lambda *xs: "'[' || " + " || ',' || ".join(map(text, xs)) + " || ']'"
    number = lambda k: f"cast({p} * 2 + {k} AS varchar(20))"
    market = lambda k: "chr(123) || " + " || ',' || ".join([
        field("id", text(number(k))), field("condition_id", text(f"'0X' || {d.hex64(f'{p} * 2 + {k}')}")), field("clob_token_ids", listed(f"{number(k)} || '1'", f"{number(k)} || '2'")),
        field("outcomes", listed(f"CASE WHEN {p} % 7 = 3 THEN 'Down' ELSE 'No' END", f"CASE WHEN {p} % 7 = 4 THEN 'NO' ELSE 'Yes' END")), field("tags", f"CASE {k} WHEN 0 THEN {listed(chr(39) + 'Finance' + chr(39), 'p_brand')} ELSE 'null' END"),
    ]) + " || chr(125)"
    return f"""
        SELECT {p} AS id, CASE WHEN {p} % 29 = 6 THEN 'oops' WHEN {p} % 23 = 2 THEN chr(123) || {field("id", text("'none'"))} || chr(125) ELSE chr(123) || {field("id", text(f"'e' || cast({p} AS varchar(20))"))} || ',' || {field("slug", text("lower(p_brand)"))}
            || ',' || {field("tags", "'[' || chr(123) || " + field("slug", text("'Science'")) + " || chr(125) || ',' || " + text("p_type") + " || ']'")} || ',' || {field("subcategory", f"CASE {p} % 4 WHEN 1 THEN {text(chr(39) + ' Sub  Cat' + chr(39))} ELSE 'null' END")}
            || ',' || {field("markets", f"'[' || {market(0)} || ',' || CASE {p} % 5 WHEN 2 THEN 'null' ELSE {market(1)} END || ']'")} || chr(125) END AS payload
        FROM {{part}}"""


def catalog_rows(d: Dialect) -> str:
    """Catalogue rows to identify: id, conditionId, version, clobTokenIds, positionIds, outcomes, closed, enableOrderBook."""
    q, p = "chr(34)", "p_partkey"
    two = lambda a, b: f"'[' || {q} || {a} || {q} || ',' || {q} || {b} || {q} || ']'"
    n = lambda k: f"cast({p} * 10 + {k} AS varchar(20))"
    return f"""
        SELECT cast({p} AS varchar(20)) AS id, CASE WHEN {p} % 31 = 4 THEN '' ELSE '0x' || {d.hex64(p)} END AS "conditionId", CASE {p} % 7 WHEN 1 THEN 'V2' WHEN 2 THEN '2' WHEN 3 THEN 'v3' WHEN 4 THEN 'v1' ELSE NULL END AS version,
            CASE {p} % 11 WHEN 3 THEN {two(n(1), n(1))} WHEN 4 THEN {two(n(1), "'x'")} ELSE {two(n(1), n(2))} END AS "clobTokenIds", {two(n(3), n(4))} AS "positionIds",
            CASE WHEN {p} % 13 = 5 THEN '[]' ELSE {two("'Yes'", "'No'")} END AS outcomes, {p} % 9 = 4 AS closed, CASE {p} % 5 WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS "enableOrderBook"
        FROM {{part}}""".replace('"', "`" if d.spark else '"')


def unnamed_markets(d: Dialect) -> str:
    """Markets by their marks: market_id, category, slug, tags, condition_id, identity_kind, gamma_market_id."""
    p = "p_partkey"
    return f"""
        SELECT {p} AS market_id, CASE {p} % 10 WHEN 0 THEN 'OrderFilled-Placeholder' WHEN 1 THEN '[ghost]' WHEN 2 THEN 'Ghost' ELSE 'x' END AS category,
            CASE {p} % 12 WHEN 3 THEN 'trade-indexer-placeholder-7' WHEN 4 THEN 'Combo-9' WHEN 5 THEN 'ghost-market-1' WHEN 6 THEN 'onchain-condition-v2-a' ELSE 'm' END AS slug,
            CASE {p} % 4 WHEN 0 THEN 'data-api-combo' WHEN 1 THEN 'Combo, x' WHEN 2 THEN 'orphaned,unknown' ELSE NULL END AS tags, CASE WHEN {p} % 3 = 2 THEN ' 0x' || repeat('0', 64) ELSE '0x1' END AS condition_id,
            CASE {p} % 6 WHEN 0 THEN 'canonical_gamma' WHEN 1 THEN 'official_combo' WHEN 2 THEN 'other' WHEN 3 THEN 'canonical_clob' ELSE 'chain_v2' END AS identity_kind, CASE {p} % 5 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'g' END AS gamma_market_id
        FROM {{part}}"""


def frames(d: Dialect) -> str:
    """Captured frames as text: pos, raw. Some hold two messages, some are broken, some are heartbeats."""
    k, q = d.number("props"), "chr(34)"
    pair = lambda name, value: f"{q} || '{name}' || {q} || ':' || {q} || {value} || {q}"
    price = f"'0.' || lpad(cast({k} % 99 + 1 AS varchar(3)), 2, '0') || CASE WHEN event_id % 4 = 1 THEN '00' ELSE '' END"
    level = "chr(123) || " + pair("price", price) + " || ',' || " + pair("size", "cast(cast(round(value) AS bigint) AS varchar(20)) || '.50'") + " || chr(125)"
    book = "chr(123) || " + pair("event_type", "'book'") + " || ',' || " + pair("market", "cast(user_id AS varchar(20))") + " || ',' || " + pair("asset_id", "cast(event_id % 2 AS varchar(2))") + f" || ',' || {q} || 'bids' || {q} || ':[' || {level} || '],' || {q} || 'asks' || {q} || ':[]' || chr(125)"
    last = "chr(123) || " + pair("event_type", "'last_trade'") + " || ',' || " + pair("market", "cast(user_id AS varchar(20))") + " || chr(125)"
    return f"""
        SELECT event_id AS pos, CASE WHEN event_id % 31 = 4 THEN 'PING' WHEN event_id % 37 = 6 THEN chr(123) || 'oops' WHEN event_id % 41 = 9 THEN '[' || {last} || ',' || chr(123) || chr(125) || ']'
            WHEN event_id % 3 = 0 THEN '[' || {book} || ',' || {last} || ']' WHEN event_id % 3 = 1 THEN {book} ELSE {last} END AS raw FROM {{events}}"""


def ancillary(d: Dialect) -> str:
    """Ancillary texts of questions: id, text."""
    return """
        SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 3 THEN 'nothing here' ELSE 'q: title: ' || p_name || ' ?, description: about ' || p_brand || '. MARKET_ID: ' || cast(p_partkey * 7 AS varchar(20))
            || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' p1: 0, p2: 1.5' END END AS text FROM {part}"""


def positions(d: Dialect) -> str:
    """Combination positions: id, owner, position (64 digits). Some have a wrong module or outcome."""
    return f"""
        SELECT event_id AS id, user_id AS owner, CASE event_id % 11 WHEN 5 THEN '04' WHEN 3 THEN '01' WHEN 2 THEN '02' ELSE CASE WHEN event_id % 2 = 0 THEN '03' ELSE '01' END END
            || substr({d.hex64('event_id * 977 % 100003')}, 5) || CASE event_id % 13 WHEN 4 THEN '07' ELSE CASE event_id % 2 WHEN 0 THEN '00' ELSE '01' END END AS position FROM {{events}}"""


def settlement_markets(d: Dialect) -> str:
    """Markets to settle: id, identity_kind, condition_id, active, closed, open_until (minutes, -1: none)."""
    return f"""
        SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'combo' ELSE 'gamma' END AS identity_kind,
            CASE WHEN p_partkey % 19 = 7 THEN '0xlegacy' WHEN p_partkey % 17 = 4 THEN '0x03' || substr({d.hex64('p_partkey')}, 5) || '' WHEN p_partkey % 17 = 5 THEN '0x01' || substr({d.hex64('p_partkey')}, 5, 60)
                ELSE '0x' || {d.hex64('p_partkey + 1')} END AS condition_id,
            p_partkey % 4 <> 1 AS active, p_partkey % 5 = 2 AS closed, CASE p_partkey % 7 WHEN 3 THEN 100 WHEN 4 THEN -1 ELSE 1000000000 END AS open_until
        FROM {{part}}"""


def settlement_tokens(d: Dialect) -> str:
    """Tokens of those markets: market_id, token_id (decimal text), outcome_index, outcome, condition_id."""
    condition = f"CASE WHEN p_partkey % 19 = 7 THEN '0xlegacy' ELSE '0x' || {d.hex64('p_partkey + 1')} END"
    return f"""
        SELECT p_partkey AS market_id, cast(p_partkey * 100 + s + 1 AS varchar(30)) AS token_id, cast(CASE WHEN p_partkey % 23 = 6 THEN 0 ELSE s END AS int) AS outcome_index,
            'position_' || cast(s AS varchar(2)) AS outcome, {condition} AS condition_id
        FROM {{part}}, (SELECT 0 AS s UNION ALL SELECT 1) AS slots WHERE p_partkey % 29 <> 8"""


def settlement_events(d: Dialect) -> str:
    """Resolution and adjudication events: the columns that settlement evidence reads; block_time is minutes."""
    k, market = d.number("props"), "(user_id * 13 + event_id) % 400"
    return f"""
        SELECT event_id AS id, '0x' || {d.hex64(market + ' + 1')} AS condition_id, {market} AS market_id,
            CASE event_type WHEN 'view' THEN 'request' WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'propose' ELSE 'settle' END WHEN 'error' THEN 'dispute' ELSE 'settle' END AS event_status,
            CASE event_id % 4 WHEN 0 THEN '0xbb1a8db2d4350976a11cdfa60a1d43f97710da49' ELSE '0x4d97dcd97ec945f40cf65f87097ace5ea0476045' END AS source_oracle,
            CASE WHEN event_id % 43 = 2 THEN 'nobody' ELSE '0x' || substr({d.hex64('user_id')}, 25) END AS source_adapter, '0x' || {d.hex64('event_id')} AS adapter_question_id,
            {d.div(d.millis('ts'), 60000)} AS block_number, event_id % 100 AS log_index, '0x' || {d.hex64('event_id * 3')} AS tx_hash, {d.div(d.millis('ts'), 60000)} AS event_time,
            CASE {k} % 11 WHEN 3 THEN '[0,0]' WHEN 4 THEN '[01,2]' WHEN 5 THEN 'oops' WHEN 6 THEN '[1, 2, 3]' ELSE '[' || cast({k} AS varchar(20)) || ', ' || cast(100 - {k} % 100 AS varchar(20)) || ']' END AS payout
        FROM {{events}}"""


def condition_logs(d: Dialect) -> str:
    """Logs of condition preparations (topic 0x04) and resolutions (0x05), some broken."""
    w, k = d.hex64, d.number("props")
    return f"""
        SELECT '0xCC' AS address, CASE WHEN event_id % 43 = 7 THEN '0x99' WHEN event_type = 'view' THEN '0x04' ELSE '0x05' END AS topic0,
            '0x' || {w('user_id * 13 + event_id % 13')} AS topic1, '0x' || {w('user_id + 5')} AS topic2, '0x' || {w('event_id')} AS topic3,
            '0x' || CASE WHEN event_type = 'view' THEN {w('2')} ELSE {w("CASE WHEN event_id % 29 = 3 THEN 3 ELSE 2 END")} || {w('64')} || {w("CASE WHEN event_id % 31 = 4 THEN 9 ELSE 2 END")} || {w(k)} || {w('100 - ' + k + ' % 100')} END AS data,
            '0x' || {w('event_id')} AS tx_hash, event_id % 100 AS log_index, event_id AS block_number
        FROM {{events}}"""


def request_logs(d: Dialect) -> str:
    """Logs of price requests (topic 0x01) and settlements (0x02) with ancillary text."""
    w = d.hex64
    text = "lower(hex('q: title: ' || p_name || ', description: d. market_id: ' || cast(p_partkey AS varchar(20))))"
    blob = f"{w(d.div('length(' + text + ')', 2))} || rpad({text}, 256, '0')"
    price = f"CASE p_partkey % 3 WHEN 0 THEN {w('1000000000000000000')} WHEN 1 THEN {w('0')} ELSE repeat('f', 63) || 'b' END"
    return f"""
        SELECT '0xAB' AS address, CASE WHEN p_partkey % 17 = 5 THEN '0x77' WHEN p_partkey % 2 = 0 THEN '0x01' ELSE '0x02' END AS topic0, '0x' || {w('p_partkey % 7')} AS topic1, '0x' || {w('p_partkey % 5 + 10')} AS topic2, '0x' || {w('3')} AS topic3,
            '0x' || {w('1')} || {w('2')} || CASE WHEN p_partkey % 19 = 4 THEN {w('9999')} ELSE {w('192')} END || CASE WHEN p_partkey % 2 = 0 THEN {w('4')} ELSE {price} END || {w('p_partkey')} || {w('6')} || {blob} AS data,
            '0x' || {w('p_partkey')} AS tx_hash, p_partkey % 10 AS log_index, p_partkey AS block_number, p_name AS name, p_partkey AS id
        FROM {{part}}"""


def module_events(d: Dialect) -> str:
    """Results of module conditions: id, module_address, condition_id, event_name, payouts, tx_hash, block_number, log_index, event_time."""
    k = d.number("props")
    first, second = "0x1000008dd9001b968442c1000017eae6e0da00ba", "0x200000900045e3b6259600682756002200028933"
    part = f"({k} * 9973 % 1000001)"
    return f"""
        SELECT event_id AS id, CASE event_id % 2 WHEN 0 THEN '{first}' ELSE '{second}' END AS module_address,
            CASE WHEN event_id % 31 = 3 THEN '0x03' WHEN event_id % 2 = 0 THEN '0x01' ELSE '0x02' END || substr({d.hex64('user_id * 100 + event_id % 100')}, 5) AS condition_id, CASE event_type WHEN 'error' THEN 'ConditionPrepared' ELSE 'ConditionResolved' END AS event_name,
            CASE {k} % 13 WHEN 3 THEN '[1000000, 1]' WHEN 4 THEN '[01,2]' WHEN 5 THEN NULL WHEN 6 THEN '[0, 1000000]' ELSE '[' || cast({part} AS varchar(20)) || ',' || cast(1000000 - {part} AS varchar(20)) || ']' END AS payouts,
            CASE WHEN event_id % 37 = 5 THEN 'lost' ELSE '0x' || {d.hex64('event_id')} END AS tx_hash, {d.div(d.millis('ts'), 60000)} AS block_number, event_id % 100 AS log_index, {d.millis('ts')} AS event_time
        FROM {{events}}"""


def implementations(d: Dialect) -> str:
    """Implementations of modules that were seen or upgraded to: seen, module_address, implementation, block_number, log_index."""
    return f"""
        SELECT event_id % 2 = 0 AS seen, CASE event_id % 3 WHEN 0 THEN '0x1000008dd9001b968442c1000017eae6e0da00ba' WHEN 1 THEN '0x200000900045e3b6259600682756002200028933' ELSE '0x30000034706c7d8e12009dab006be20000c031a8' END AS module_address,
            CASE event_id % 3 WHEN 0 THEN '0x492FEC596ec347459e1ebe30b9245eb3b49b1bba' WHEN 1 THEN CASE WHEN event_id % 7 = 2 THEN '0xnew' ELSE '0xa61e7ca374f721d5b9fd5b0fee6fb90f27d448d7' END ELSE '0x572cd48cce93b2e58f1cc0253a7fdd4b4952a9c2' END AS implementation,
            {d.div(d.millis('ts'), 600000)} AS block_number, event_id AS log_index
        FROM {{events}} WHERE event_id % 97 < 9"""


def preparations(d: Dialect) -> str:
    """Combinations and their legs: id, condition_id, legs (words joined by commas), block_number, log_index."""
    leg = lambda k: f"CASE WHEN (user_id * 100 + (event_id + {k}) % 100) % 2 = 0 THEN '01' ELSE '02' END || substr({d.hex64(f'user_id * 100 + (event_id + {k}) % 100')}, 5) || CASE (event_id + {k}) % 3 WHEN 0 THEN '00' ELSE '01' END"
    return f"""
        SELECT event_id AS id, '0x03' || substr({d.hex64('user_id * 1000 + event_id % 50')}, 5) AS condition_id,
            {leg(0)} || ',' || CASE WHEN event_id % 11 = 4 THEN {leg(0)} ELSE {leg(2)} END || CASE event_id % 4 WHEN 1 THEN ',' || {leg(4)} ELSE '' END AS legs, event_id AS block_number, 0 AS log_index
        FROM {{events}} WHERE event_type <> 'error' AND event_id % 100 < 94"""


def module_markets(d: Dialect) -> str:
    """Markets of modules and their two tokens: id, condition_id, first and second (64-digit positions), active, closed."""
    return f"""
        SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN '0x01' ELSE '0x02' END || substr({d.hex64('p_partkey')}, 5) AS condition_id, CASE WHEN p_partkey % 17 = 3 THEN 1 ELSE 0 END AS swapped, p_partkey % 3 = 0 AS active, p_partkey % 4 = 0 AS closed
        FROM {{part}}"""


def legs(d: Dialect) -> str:
    """Legs with the words of their positions: leg_id, condition_id, outcome_index, word (64 digits, or none)."""
    return f"""
        SELECT p_partkey AS leg_id, CASE p_partkey % 7 WHEN 3 THEN '0x04' WHEN 4 THEN '0x02' ELSE '0x01' END || substr({d.hex64('p_partkey')}, 5) AS condition_id, cast(p_partkey % 3 AS int) AS outcome_index,
            CASE WHEN p_partkey % 5 = 2 THEN 'none' ELSE CASE p_partkey % 7 WHEN 3 THEN '04' WHEN 4 THEN '02' ELSE '01' END || substr({d.hex64('p_partkey')}, 5) || CASE WHEN p_partkey % 11 = 4 THEN 'ff' ELSE '0' || cast(p_partkey % 3 AS varchar(2)) END END AS word
        FROM {{part}}"""


def adapter_logs(d: Dialect) -> str:
    """Logs of adapters of both eras: initialised (0x11), reset (0x12), resolved (0x13), settled (0x14), some broken."""
    w = d.hex64
    text = "lower(hex('q ' || cast(p_partkey AS varchar(20)) || ' ' || p_brand))"
    price = f"CASE p_partkey % 3 WHEN 0 THEN {w('1000000000000000000')} WHEN 1 THEN {w('0')} ELSE repeat('f', 63) || 'b' END"
    return f"""
        SELECT p_partkey AS id, CASE p_partkey % 2 WHEN 0 THEN '0xOLD' ELSE '0xNEW' END AS address, CASE WHEN p_partkey % 23 = 4 THEN '0x99' WHEN p_partkey % 7 < 2 THEN '0x11' WHEN p_partkey % 7 = 2 THEN '0x12' WHEN p_partkey % 7 < 5 THEN '0x13' ELSE '0x14' END AS topic0,
            '0x' || {w('p_partkey % 500')} AS topic1, '0x' || {price} AS topic2, '0x' || {w('p_partkey % 4 - p_partkey % 2')} AS topic3, '0x' || {w('p_partkey')} AS tx_hash, p_partkey % 10 AS log_index, p_partkey AS block_number,
            '0x' || CASE WHEN p_partkey % 19 = 3 THEN {w('4096')} ELSE {w('32')} END || {w(d.div('length(' + text + ')', 2))} || rpad({text}, 128, '0') AS data
        FROM {{part}}"""


def module_logs(d: Dialect) -> str:
    """Logs of modules: resolved (0x21), reported (0x22), combination prepared (0x23), upgraded (0x24), migrated (0x25)."""
    w, k = d.hex64, d.number("props")
    part = f"({k} * 9973 % 1000001)"
    module = "CASE event_id % 4 WHEN 0 THEN '0xM1' WHEN 1 THEN '0xM2' WHEN 2 THEN '0xM3' ELSE '0xM1' END"
    own = "CASE WHEN event_id % 41 = 8 THEN '09' WHEN event_id % 4 = 1 THEN '02' WHEN event_id % 4 = 2 THEN '03' ELSE '01' END"
    topic = f"'0x' || {own} || substr({w('event_id')}, 5) || '00'"
    pair = f"{w(part)} || CASE WHEN event_id % 29 = 6 THEN {w('7')} ELSE {w('1000000 - ' + part)} END"
    return f"""
        SELECT event_id AS id, {module} AS address, CASE event_type WHEN 'view' THEN '0x21' WHEN 'click' THEN '0x22' WHEN 'purchase' THEN '0x23' WHEN 'error' THEN '0x24' ELSE '0x25' END AS topic0, {topic} AS topic1, {topic} AS topic2, '0x' || {w('0')} AS topic3,
            '0x' || {w('event_id')} AS tx_hash, event_id % 100 AS log_index, event_id AS block_number, '0x' || CASE WHEN event_type = 'signup' THEN {w('0')} || {w('1')} || {pair} ELSE {w('32')} || {w('2')} || {pair} END AS data
        FROM {{events}}"""


def capture(d: Dialect) -> str:
    """Records of a capture: pos, kind, shard, lane, connection, market, raw. Every shard and lane connects at first; some
    frames are of an older connection, keepalives, broken, or of a market that is not in scope."""
    k, q, market = d.number("props"), "chr(34)", "user_id % 40"
    pair = lambda name, value: f"{q} || '{name}' || {q} || ':' || {q} || {value} || {q}"
    obj = lambda *parts: "chr(123) || " + " || ',' || ".join(parts) + " || chr(125)"
    listed = lambda name, *items: f"{q} || '{name}' || {q} || ':[' || " + " || ',' || ".join(items) + " || ']'"
    asset = lambda shift: f"'t' || cast({market} AS varchar(9)) || '-' || cast(({d.div('event_id', 2)} + {shift}) % 2 AS varchar(2))"
    price = lambda n: f"'0.' || lpad(cast(({k} * {n} + {n}) % 99 + 1 AS varchar(3)), 2, '0') || CASE WHEN event_id % 4 = 1 THEN '00' ELSE '' END"
    size = f"cast(CASE WHEN event_type = 'purchase' THEN 0 ELSE cast(round(value) AS bigint) + 1 END AS varchar(20)) || CASE WHEN event_id % 3 = 1 THEN '.0' ELSE '' END"
    level = lambda n: obj(pair("price", price(n)), pair("size", size))
    named = pair("market", f"CASE WHEN event_id % 43 = 7 THEN 'other' ELSE cast({market} AS varchar(9)) END")
    book = obj(pair("event_type", "'book'"), named, pair("asset_id", asset(0)), f"CASE WHEN {k} % 99 = 98 THEN {listed('bids', level(1))} ELSE {listed('bids', level(1), level(5))} END", listed("asks", level(7)))
    row = lambda shift, n: obj(pair("asset_id", asset(shift)), pair("side", "CASE event_id % 3 WHEN 0 THEN 'SELL' ELSE 'BUY' END"), pair("price", price(n)), pair("size", size))
    change = obj(pair("event_type", "'price_change'"), named, f"CASE WHEN event_id % 5 = 2 THEN {listed('price_changes', row(0, 1), row(1, 3))} ELSE {listed('price_changes', row(0, 5))} END")
    broken = obj(pair("event_type", "'book'"), named)
    last = f"max(CASE WHEN event_id % 1009 = 1 THEN event_id ELSE -1 END) OVER (PARTITION BY {market} % 3, event_id % 2 ORDER BY event_id)"
    return f"""
        SELECT event_id AS pos, CASE WHEN event_id % 1009 = 1 THEN 'CONNECT' WHEN event_id % 1511 = 2 THEN 'DISCONNECT' WHEN event_id % 499 = 3 THEN 'SOURCE_ASSIGNED' WHEN event_id % 797 = 4 THEN 'SOURCE_STATE_RELEASED' ELSE 'RAW' END AS kind,
            {market} % 3 AS shard, event_id % 2 AS lane, {last} - CASE WHEN event_id % 47 = 5 THEN 1000 ELSE 0 END AS connection, cast({market} AS varchar(9)) AS market,
            CASE WHEN event_id % 31 = 4 THEN 'PONG' WHEN event_id % 37 = 6 THEN chr(123) || 'oops' WHEN event_id % 41 = 9 THEN '[' || {book} || ',' || {broken} || ',' || {change} || ']' WHEN event_id % 29 = 8 THEN '[]'
                WHEN event_type = 'signup' THEN {book} WHEN event_type = 'error' THEN '[' || {change} || ',' || {book} || ']' ELSE {change} END AS raw
        FROM {{events}}
        UNION ALL SELECT -1 - s * 2 - l, 'CONNECT', s, l, -1, NULL, NULL FROM (SELECT DISTINCT {market} % 3 AS s, event_id % 2 AS l FROM {{events}}) AS slots"""


def capture_scope(d: Dialect) -> str:
    """Markets in scope and their two assets: market, asset."""
    return """
        SELECT DISTINCT cast(user_id % 40 AS varchar(9)) AS market, 't' || cast(user_id % 40 AS varchar(9)) || '-' || cast(s AS varchar(2)) AS asset
        FROM {events}, (SELECT 0 AS s UNION ALL SELECT 1) AS sides"""


def gateway_records(d: Dialect) -> str:
    """Records that plants send: plant, seq, kind, session, stream, offset, bytes, digest. Some repeat an offset, a few of
    them with another content, some are of an older session or of another stream."""
    return """
        SELECT plant, seq, CASE WHEN starts THEN 'SESSION' ELSE 'RECORD' END AS kind, 's' || cast(CASE WHEN seq % 37 = 5 AND NOT starts THEN own - 1 ELSE own END AS varchar(20)) AS session,
            CASE WHEN seq % 41 = 6 AND NOT starts THEN 'old' ELSE 'g' || cast(own AS varchar(20)) END AS stream, n - CASE WHEN seq % 5 = 2 THEN 3 WHEN seq % 17 = 4 THEN 40 ELSE 0 END AS offset, 20 + seq % 50 AS bytes,
            CASE WHEN seq % 23 = 9 THEN 'x' || cast(seq AS varchar(20)) ELSE 'd' || cast(n - CASE WHEN seq % 5 = 2 THEN 3 WHEN seq % 17 = 4 THEN 40 ELSE 0 END AS varchar(20)) END AS digest
        FROM (SELECT plant, seq, starts, coalesce(max(CASE WHEN starts THEN seq END) OVER (PARTITION BY plant ORDER BY seq), -5) AS own, row_number() OVER (PARTITION BY plant ORDER BY seq) AS n
            FROM (SELECT user_id % 8 AS plant, event_id AS seq, event_id % 211 = 7 AS starts FROM {events}) AS a) AS b"""


def transport_probes(d: Dialect) -> str:
    """Probes of transports: id, connection, session, kind, ms. Pings and pongs alternate but for some."""
    return f"""
        SELECT id, connection, session, CASE WHEN id % 29 = 3 THEN 'PING' WHEN n % 2 = 1 THEN 'PING' ELSE 'PONG' END AS kind, ms
        FROM (SELECT event_id AS id, user_id % 10 AS connection, {d.div('event_id', 700)} AS session, {d.millis('ts')} AS ms, row_number() OVER (PARTITION BY user_id % 10, {d.div('event_id', 700)} ORDER BY event_id) AS n FROM {{events}}) AS a"""


def soak_samples(d: Dialect) -> str:
    """Samples of deployments: key, id, ms, fingerprint."""
    return f"SELECT user_id % 12 AS key, event_id AS id, {d.millis('ts')} AS ms, {d.div('event_id', 1300)} % 3 AS fingerprint FROM {{events}} WHERE event_id % 500 < 430"


def _combo_position(d: Dialect, shift: str) -> str:
    return f"CASE WHEN event_id % 61 = 7 THEN '01' ELSE '03' END || substr({d.hex64(f'user_id * 10 + event_id % 7')}, 5) || CASE WHEN (event_id + {shift}) % 2 = 0 THEN '00' ELSE '01' END"


def combo_fills(d: Dialect) -> str:
    """Trades of combinations: position, tx_hash, block_time. Some positions are of another module."""
    return f"SELECT {_combo_position(d, '0')} AS position, '0x' || {d.hex64(d.div('event_id', 2))} AS tx_hash, {d.millis('ts')} AS block_time FROM {{events}}"


def combo_activity(d: Dialect) -> str:
    """Activity rows: id, tx_hash, position, is_combo, condition_id, title, outcome. Some are missing, unmarked, of another
    condition, without a title, or with a title of their own."""
    position = _combo_position(d, "0")
    return f"""
        SELECT event_id AS id, '0x' || {d.hex64(d.div('event_id', 2))} AS tx_hash, {position} AS position, event_id % 227 <> 3 AS is_combo, '0X' || substr({position}, 1, 60) || CASE WHEN event_id % 229 = 4 THEN 'ff' ELSE substr({position}, 61, 2) END AS condition_id,
            CASE WHEN event_id % 233 = 5 THEN ' ' WHEN event_id % 113 = 6 THEN 'Other' ELSE 'Combo  ' || cast(user_id AS varchar(9)) END AS title, CASE WHEN event_id % 239 = 6 THEN 'Yes' ELSE '' END AS outcome
        FROM {{events}} WHERE event_id % 241 <> 9"""


def combo_details(d: Dialect) -> str:
    """Details of combinations: id, position, condition_id, module_id, and two legs as columns (title, outcome)."""
    position = _combo_position(d, "1")
    return f"""
        SELECT event_id AS id, {position} AS position, '0x' || CASE WHEN event_id % 19 = 4 THEN 'zz' ELSE substr({position}, 1, 2) END || substr({position}, 3, 60) AS condition_id, CASE WHEN event_id % 17 = 3 THEN 2 ELSE 3 END AS module_id,
            CASE WHEN event_id % 23 = 5 THEN '' ELSE 'Team ' || cast(user_id AS varchar(9)) || ' wins' END AS title, CASE event_id % 3 WHEN 0 THEN 'Wins' WHEN 1 THEN '' ELSE 'No' END AS outcome
        FROM {{events}} WHERE user_id % 3 <> 1"""


def combo_markets(d: Dialect) -> str:
    """Markets that are there before combinations are installed: condition_id, identity_kind, gamma_market_id, question_id, yes_token, no_token."""
    head = f"'03' || substr({d.hex64('u * 10 + k')}, 5)"
    return f"""
        SELECT '0x' || {head} AS condition_id, CASE u % 4 WHEN 0 THEN 'legacy_combo' WHEN 1 THEN 'official_combo' ELSE 'canonical_gamma' END AS identity_kind, CASE WHEN u % 5 = 2 THEN 'g' ELSE ' ' END AS gamma_market_id, NULL AS question_id,
            {head} || CASE WHEN u % 7 = 3 THEN '01' ELSE '00' END AS yes_token, {head} || '01' AS no_token
        FROM (SELECT DISTINCT user_id AS u, event_id % 7 AS k FROM {{events}}) AS a WHERE k < 5"""


def registry_rows(d: Dialect) -> str:
    """Catalogue rows to write: condition_id, yes_token, no_token, gamma_market_id, category, normalized. Some claim the
    tokens of another condition, which is in the registry, in the batch, or in both."""
    p = "p_partkey"
    own = f"CASE WHEN {p} % 12 = 2 THEN {p} - 1 WHEN {p} % 24 = 8 THEN {p} - 3 WHEN {p} % 48 = 20 THEN {p} + 3 ELSE {p} END"
    return f"""
        SELECT 'c' || lpad(cast({p} AS varchar(20)), 9, '0') AS condition_id, cast(({own}) * 10 AS varchar(20)) AS yes_token, cast(({own}) * 10 + 1 AS varchar(20)) AS no_token,
            CASE WHEN {p} % 19 = 4 THEN ' ' ELSE 'g' || cast({p} AS varchar(20)) END AS gamma_market_id, p_brand AS category, {p} % 17 <> 3 AS normalized
        FROM {{part}} WHERE {p} % 3 = 2"""


def registry_markets(d: Dialect) -> str:
    """Markets of the registry, canonical ones, shells and others: market_id, condition_id, identity_kind, gamma_market_id, category, slug."""
    p = "p_partkey"
    return f"""
        SELECT {p} * 2 AS market_id, 'c' || lpad(cast({p} AS varchar(20)), 9, '0') AS condition_id, CASE {p} % 20 WHEN 1 THEN 'canonical_gamma' WHEN 5 THEN 'protocol_structural' WHEN 9 THEN 'legacy_placeholder' WHEN 13 THEN 'legacy_placeholder' ELSE 'canonical_clob' END AS identity_kind,
            CASE {p} % 20 WHEN 1 THEN 'g' || cast({p} AS varchar(20)) WHEN 17 THEN 'x' ELSE ' ' END AS gamma_market_id, CASE {p} % 20 WHEN 9 THEN 'OrderFilled-Placeholder' ELSE 'old' END AS category,
            CASE {p} % 20 WHEN 13 THEN 'trade-indexer-placeholder-1' ELSE 'slug' END AS slug
        FROM {{part}} WHERE {p} % 4 = 1"""


def registry_tokens(d: Dialect) -> str:
    """Tokens of those markets: token_id, market_id, condition_id, id, outcome, outcome_index."""
    p = "p_partkey"
    return f"""
        SELECT cast({p} * 10 + s AS varchar(20)) AS token_id, {p} * 2 AS market_id, 'c' || lpad(cast({p} AS varchar(20)), 9, '0') AS condition_id, -({p} * 4 - 1 + s) AS id, CASE s WHEN 0 THEN 'YES' ELSE 'NO' END AS outcome, cast(s AS int) AS outcome_index
        FROM {{part}}, (SELECT 0 AS s UNION ALL SELECT 1) AS slots WHERE {p} % 4 = 1"""


def cut_states(d: Dialect) -> str:
    """States of tokens on two lanes of two plants at a cut; some are missing, twice, or lack evidence of a stage."""
    x = "(c_custkey * 7 + plant * 3 + lane * 5)"
    return f"""
        SELECT {d.div('c_custkey', 2)} AS market, c_custkey AS token, plant, lane, 'k' || cast({d.div('c_custkey', 2)} % 50 AS varchar(9)) || CASE WHEN {x} % 47 = 11 AND c_custkey % 2 = 1 THEN 'x' ELSE '' END AS connection,
            1 AS epoch, {d.div('c_custkey', 2)} % 4 AS shard, {x} % 31 <> 4 AS written, {x} % 29 <> 5 AS book_seen, CASE WHEN {x} % 37 = 6 THEN 'old' ELSE 'k' || cast({d.div('c_custkey', 2)} % 50 AS varchar(9)) || CASE WHEN {x} % 47 = 11 AND c_custkey % 2 = 1 THEN 'x' ELSE '' END END AS baseline_connection,
            {x} % 1000 AS baseline_offset, {x} % 23 <> 7 AS baseline_durable, {x} % 1000 + CASE WHEN {x} % 61 = 8 THEN 1 ELSE 0 END AS receipt_offset, CASE WHEN {x} % 67 = 9 THEN 'CROSSED' ELSE NULL END AS eligible, {x} % 19 <> 3 AS ready, CASE WHEN {x} % 5 = 1 THEN NULL ELSE 'RECOVERING' END AS status, n AS copy
        FROM {{customer}}, (SELECT 0 AS plant UNION ALL SELECT 1) AS p, (SELECT 0 AS lane UNION ALL SELECT 1) AS l, (SELECT 0 AS n UNION ALL SELECT 1) AS copies WHERE {x} % 43 <> 2 AND (n = 0 OR {x} % 89 = 3)"""
