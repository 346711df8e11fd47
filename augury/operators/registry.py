"""Market registry: normalise catalogue rows, filter token claims, keep ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.operators import tables

#: Categories that count as primary when found among tags: fixed values, in order of preference.
PRIMARY = ("politics", "sports", "crypto", "weather", "economy", "economics", "finance", "tech", "science", "pop-culture")
#: Labels that say which outcome is which; they may not stand twice. Fixed values.
LABELS = ("YES", "NO", "UP", "DOWN")
FIELDS = ("id", "gamma_market_id", "conditionId", "condition_id", "clobTokenIds", "clob_token_ids", "outcomes", "outcomePrices", "outcome_prices", "tags", "category", "categories", "closed", "createdAt", "created_at", "events", "slug")
EVENT_FIELDS = ("id", "slug", "tags", "category", "subcategory", "categories")


def collapsed(text: Column) -> Column:
    """Text with single blanks and none at its ends; null if nothing is left."""
    out = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(out != "", out)


def _list(text: Column) -> Column:
    """A JSON list as texts of its entries; null if it is none."""
    return F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>"))


def sequence_of(text: Column) -> Column:
    """A list that comes as JSON array or as JSON text of one; empty if there is none."""
    return F.coalesce(_list(text), F.array().cast("array<string>"))


def malformed(text: Column) -> Column:
    """Whether something is there that is no list."""
    return text.isNotNull() & (text != "") & _list(text).isNull()


def labelled(entry: Column) -> Column:
    """A tag or category: its text, or the slug or else the label of an object, in lower case; null if empty."""
    thing = entry.rlike(r"^\s*\{")
    named = F.coalesce(F.nullif(F.get_json_object(entry, "$.slug"), F.lit("")), F.get_json_object(entry, "$.label"))
    return F.lower(collapsed(F.when(thing, named).otherwise(entry)))


def tags_of(*texts: Column) -> Column:
    """Distinct tags of several fields in order; a field may be a list, JSON text of one, an object or a bare tag."""
    items = lambda t: F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(F.coalesce(_list(t), F.array(t)))
    found = F.transform(F.concat(*map(items, texts)), labelled)
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def boolean(text: Column) -> Column:
    """true, false, 1, 0 in any case; null otherwise."""
    low = F.lower(F.trim(text))
    return F.when(low.isin("true", "1"), True).when(low.isin("false", "0"), False)


def moment(text: Column) -> Column:
    """ISO time with up to nine fractional digits, cut to microseconds, UTC where no zone is named; microseconds."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"(\.\d{6})\d+", "$1"), "Z$", "+00:00")
    return F.unix_micros(F.try_to_timestamp(plain))


def category(candidates: list[Column], lists: Column, tags: Column) -> Column:
    """The first category named; else the first primary one among the tags, the first tag, or `other`."""
    primary = F.get(F.filter(F.array(*map(F.lit, PRIMARY)), lambda t: F.array_contains(tags, t)), 0)
    listed = F.get(F.filter(F.transform(lists, labelled), lambda x: x.isNotNull()), 0)
    return F.coalesce(*map(labelled, candidates), listed, primary, F.get(tags, 0), F.lit("other"))


def event_markets(roots: DataFrame) -> DataFrame:
    """Rows (id, ordinal, payload, event) of the markets that event pages (id, payload: JSON text) nest; payload is the
    market's JSON and event the page's. Pages that are no objects have none."""
    rows = roots.select("id", F.col("payload").alias("event"), F.get_json_object("payload", "$.markets").alias("__m"))
    each = rows.select("id", "event", F.posexplode(sequence_of(F.col("__m"))).alias("ordinal", "payload"))
    return each.where(F.col("payload").rlike(r"^\s*\{")).select("id", "ordinal", "payload", "event")


def normalize_markets(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(markets, rejects with the first reason) from rows (id, payload: JSON text) and, optionally, event: JSON text of
    the event that the market was found in; without it the first of the market's own events counts."""
    extra = [c for c in ("ordinal",) if c in pages.columns]
    given = F.col("event") if "event" in pages.columns else F.lit(None).cast("string")
    # Rows that are no objects have null fields, and are rejected for that.
    rows = pages.select("id", *extra, F.from_json("payload", ", ".join(f"{c} string" for c in FIELDS)).alias("m"), given.alias("event"))
    m = lambda *names: F.coalesce(*[F.nullif(F.col(f"m.{n}"), F.lit("")) for n in names])
    first_event = F.get(F.coalesce(_list(F.col("m.events")), F.array().cast("array<string>")), 0)
    event = F.from_json(F.coalesce("event", first_event), ", ".join(f"{c} string" for c in EVENT_FIELDS))
    rows = rows.withColumn("e", event)
    condition = F.lower(collapsed(m("conditionId", "condition_id")))
    names = lambda text: F.transform(sequence_of(text), lambda x: F.coalesce(collapsed(x), F.lit("")))
    tokens, outcomes, prices = m("clobTokenIds", "clob_token_ids"), m("outcomes"), m("outcomePrices", "outcome_prices")
    rows = rows.select(
        "id", *extra, collapsed(m("id", "gamma_market_id")).alias("own_id"), F.when(condition.startswith("0x"), condition).otherwise(F.concat(F.lit("0x"), condition)).alias("condition_id"),
        names(tokens).alias("tokens"), names(outcomes).alias("outcomes"), F.transform(sequence_of(prices), lambda x: x.try_cast("decimal(20,10)")).alias("prices"),
        *[malformed(c).alias(f"bad_{n}") for c, n in ((tokens, "tokens"), (outcomes, "outcomes"), (prices, "prices"))],
        tags_of(F.col("m.tags"), F.col("e.tags")).alias("tags"), F.col("e.id").alias("event_id"), F.col("e.slug").alias("event_slug"),
        F.array(*[F.col(c) for c in ("m.category", "e.category", "e.subcategory")]).alias("named"), F.coalesce(_list(F.col("e.categories")), sequence_of(F.col("m.categories"))).alias("listed"),
        F.col("m.closed").alias("closed"), F.when(F.col("m.closed").isNull(), True).otherwise(boolean(F.col("m.closed"))).alias("is_closed"), m("createdAt", "created_at").alias("created"), moment(m("createdAt", "created_at")).alias("created_us"),
    )
    upper = F.transform("outcomes", F.upper)
    rows = rows.withColumn("upper", upper)
    reason = (
        F.when(F.col("own_id").isNull(), "no id").when(F.col("condition_id").isNull(), "no condition").when(F.col("bad_tokens"), "tokens are no list")
        .when((F.size("tokens") != 2) | F.array_contains("tokens", "") | (F.size(F.array_distinct("tokens")) != 2), "two distinct tokens required")
        .when(F.col("bad_outcomes"), "outcomes are no list").when((F.size("outcomes") != 2) | F.array_contains("outcomes", ""), "two outcomes required")
        .when((F.get("upper", 0) == F.get("upper", 1)) & F.get("upper", 0).isin(*LABELS), "outcomes are the same label").when(F.col("bad_prices"), "prices are no list")
        .when((F.size("prices") > 0) & (F.size("prices") != 2), "two prices required").when(F.exists("prices", lambda x: F.coalesce(~x.between(0, 1), F.lit(True))), "price out of range")
        .when(F.col("is_closed").isNull(), "not a boolean").when(F.col("created").isNotNull() & F.col("created_us").isNull(), "not a time")
    )
    good, bad = tables.split(rows.withColumn("reason", reason))
    # Only the full pairs Yes and No, or Up and Down, name their sides; other labels keep their order.
    swapped = ((F.get("upper", 0) == "NO") & (F.get("upper", 1) == "YES")) | ((F.get("upper", 0) == "DOWN") & (F.get("upper", 1) == "UP"))
    yes = F.when(swapped, 2).otherwise(1)
    other = F.lit(3) - yes
    return good.select(
        "id", *extra, "condition_id", F.element_at("tokens", yes).alias("yes_token"), F.element_at("tokens", other).alias("no_token"), F.element_at("outcomes", yes).alias("yes_outcome"), F.element_at("outcomes", other).alias("no_outcome"),
        F.get("prices", yes - 1).alias("yes_price"), F.get("prices", other - 1).alias("no_price"), "tags", category([F.get("named", k) for k in range(3)], F.col("listed"), F.col("tags")).alias("category"), "event_id", "event_slug", "is_closed", "created_us",
    ), bad.select("id", *extra, "reason")


#: Versions of catalogue rows, and the kind of their tokens: fixed values.
KINDS = {"1": "CLOB_TOKEN_ID", "2": "POSITION_ID"}


def catalog_identity(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(eligible, excluded, unresolved with reason) of catalogue rows: id, conditionId, version, clobTokenIds, positionIds,
    outcomes (JSON lists), closed, enableOrderBook (booleans or null).

    Version 1 is identified by its order-book tokens, version 2 by its positions. Rows that are closed or have no order
    book are excluded before their identity is looked at.
    """
    version = F.regexp_replace(F.lower(F.coalesce("version", F.lit("1"))), "^v", "")
    kind = F.when(version == "1", KINDS["1"]).when(version == "2", KINDS["2"])
    assets = F.when(version == "1", sequence_of(F.col("clobTokenIds"))).otherwise(sequence_of(F.col("positionIds")))
    marked = rows.withColumns({"__version": version, "asset_id_kind": kind, "assets": assets, "__outcomes": sequence_of(F.col("outcomes"))})
    out = F.coalesce(F.col("closed"), F.lit(False)) | ~F.coalesce(F.col("enableOrderBook"), F.lit(True))
    binary = (F.size("assets") == 2) & (F.size(F.array_distinct("assets")) == 2) & F.forall("assets", lambda t: F.coalesce(t.rlike("^[0-9]+$"), F.lit(False)))
    reason = (
        F.when(F.col("asset_id_kind").isNull(), "UNSUPPORTED_MARKET_VERSION").when(~binary, "UNRESOLVED_BINARY_IDENTITY").when(F.size("__outcomes") != F.size("assets"), "OUTCOME_MAPPING_MISSING")
        .when(F.col("conditionId").isNull() | (F.col("conditionId") == "") | F.col("id").isNull(), "MARKET_ID_MISSING")
    )
    marked = marked.withColumns({"__out": out, "reason": reason})
    eligible = marked.where("not __out and reason is null").select("id", F.col("conditionId").alias("market"), F.col("__version").alias("version"), "asset_id_kind", "assets", F.col("__outcomes").alias("outcomes"))
    return eligible, marked.where("__out").select("id", "closed", "enableOrderBook"), marked.where("not __out and reason is not null").select("id", "reason")


def identity_classes(markets: DataFrame) -> DataFrame:
    """Markets without an id of the catalogue (market_id, category, slug, tags, condition_id) with the one class that their
    marks name, and the number of marks."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    tagged, named = lambda t: F.contains(low("tags"), F.lit(t)), lambda p: low("slug").startswith(p)
    marks = {
        "legacy_placeholder": (low("category") == "orderfilled-placeholder") | named("trade-indexer-placeholder-"),
        "legacy_combo": tagged("data-api-combo") | (named("combo-") & tagged("combo")),
        "legacy_ghost": low("category").isin("ghost", "[ghost]") | named("ghost-market-") | (tagged("orphaned") & tagged("unknown")),
        "chain_v2": named("onchain-condition-v2-"),
        "invalid_shell": F.trim(low("condition_id")) == "0x" + "0" * 64,
    }
    count = sum((m.cast("long") for m in marks.values()), F.lit(0).cast("long"))
    return markets.select("market_id", F.coalesce(*[F.when(m, F.lit(k)) for k, m in marks.items()]).alias("target_kind"), count.alias("marks"))


def identity_gate(classes: DataFrame) -> DataFrame:
    """One row: markets by class, those without a mark and those with several; `passed` if neither of these is there."""
    kinds = ("legacy_placeholder", "legacy_combo", "legacy_ghost", "chain_v2", "invalid_shell")
    out = classes.agg(F.count("*").alias("total"), *[F.count_if(F.col("target_kind") == k).alias(k) for k in kinds], F.count_if(F.col("marks") == 0).alias("unclassified"), F.count_if(F.col("marks") > 1).alias("overlapping"))
    return out.withColumn("passed", (F.col("unclassified") == 0) & (F.col("overlapping") == 0))


def rule_violations(markets: DataFrame) -> DataFrame:
    """Markets (market_id, identity_kind, gamma_market_id) that break a rule, with each rule they break."""
    known = ("canonical_gamma", "protocol_structural", "official_combo", "canonical_clob", "legacy_placeholder", "legacy_combo", "legacy_ghost", "chain_v2", "invalid_shell")
    source = F.coalesce(F.trim("gamma_market_id") != "", F.lit(False))
    broken = tables.reasons(
        (F.col("identity_kind").isin(*known), "identity kind"), ((F.col("identity_kind") != "canonical_gamma") | source, "canonical without source"),
        (~source | F.col("identity_kind").isin("canonical_gamma", "canonical_clob"), "source without canonical kind"),
    )
    return markets.select("market_id", F.explode(broken).alias("rule"))


def filter_claims(claims: DataFrame, owned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, blocked with reason) conditions: a condition is blocked if one of its tokens is claimed by another
    condition of the batch, or belongs to another condition already. Rows: condition_id, token."""
    per_token = claims.groupBy("token").agg(F.min("condition_id").alias("__lo"), F.max("condition_id").alias("__hi"))
    held = owned.groupBy("token").agg(F.min("condition_id").alias("__owner"))
    marked = claims.join(per_token, "token").join(held, "token", "left")
    per = marked.groupBy("condition_id").agg(F.max(F.col("__lo") != F.col("__hi")).alias("batch"), F.max(F.coalesce(F.col("__owner") != F.col("condition_id"), F.lit(False))).alias("taken"))
    per = per.withColumn("reason", F.when(F.col("taken"), "token belongs to another condition").when(F.col("batch"), "token claimed twice in batch"))
    accepted, blocked = tables.split(per)
    return accepted.select("condition_id"), blocked.select("condition_id", "reason")


FAILURE_RULES = {"reason": "replace", "occurrences": "sum", "first_seen": "least", "last_seen": "greatest", "status": "keep"}


def merge_failures(ledger: DataFrame, failures: DataFrame) -> DataFrame:
    """Failure ledger by key: counts add up, a status once closed stays."""
    return tables.merge_table(ledger, failures, ["failure_key"], FAILURE_RULES)


def failure_key(*parts: str) -> Column:
    return F.sha2(F.to_json(F.array(*[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])), 256)


def probe_health(probes: DataFrame, limit_ms: int = 2_000, needed: int = 3) -> tuple[DataFrame, DataFrame]:
    """(answered probes, sessions) from pings and pongs (id, connection, session, kind, ms).

    A pong answers the one ping that is outstanding; a pong without one is unmatched. A ping while another is outstanding
    makes its session ambiguous, and so it stays: nothing in it is matched any more. An answer later than limit_ms is late;
    a connection is healthy while the last `needed` answers of its session were all in time.
    """
    w = tables.Window.partitionBy("connection", "session").orderBy("ms", "id")
    rows = probes.withColumns({"__kind": F.lag("kind").over(w), "__ms": F.lag("ms").over(w)})
    overlap = (F.col("kind") == "PING") & F.coalesce(F.col("__kind") == "PING", F.lit(False))
    rows = rows.withColumn("ambiguous", F.max(overlap).over(w))
    rows = rows.withColumn("matched", (F.col("kind") == "PONG") & F.coalesce(F.col("__kind") == "PING", F.lit(False)) & ~F.col("ambiguous"))
    answers = rows.where("matched").withColumn("rtt_ms", F.col("ms") - F.col("__ms")).withColumn("late", F.col("rtt_ms") > limit_ms)
    good = F.sum((~F.col("late")).cast("int")).over(w.rowsBetween(1 - needed, 0))
    sessions = rows.groupBy("connection", "session").agg(F.count_if(F.col("kind") == "PING").alias("pings"), F.count_if("matched").alias("answers"), F.count_if((F.col("kind") == "PONG") & ~F.col("matched")).alias("unmatched"), F.max("ambiguous").alias("ambiguous"))
    return answers.select("id", "connection", "session", "rtt_ms", "late", (good == needed).alias("healthy")), sessions


def upsert_registry(rows: DataFrame, markets: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(markets, tokens, conflicts) after adding normalised rows (condition_id, yes_token, no_token, category).

    Conditions whose tokens are claimed elsewhere are conflicts and change nothing. Known conditions keep their id and
    take a new category; new ones get ids after the highest, in the order of their condition, by distributed ranks. Of rows
    that repeat a condition the greatest counts.
    Tokens of a market have the ids 2m - 1 and 2m, negated.
    """
    claims = rows.select("condition_id", F.explode(F.array("yes_token", "no_token")).alias("token"))
    owned = tokens.join(markets.select("market_id", "condition_id"), "market_id").select("condition_id", F.col("token_id").alias("token"))
    accepted, conflicts = filter_claims(claims, owned)
    good = rows.join(accepted, "condition_id", "left_semi").groupBy("condition_id").agg(F.max(F.struct("yes_token", "no_token", "category")).alias("r")).select("condition_id", "r.*")
    new = good.join(markets.select("condition_id"), "condition_id", "left_anti").select("condition_id", "yes_token", "no_token", "category")
    top = markets.agg(F.coalesce(F.max("market_id"), F.lit(0)).alias("__top"))
    placed = tables.ranked(new, ["condition_id"], "__n").crossJoin(F.broadcast(top)).withColumn("market_id", F.col("__top") + F.col("__n") + 1)
    changed = markets.join(good.select("condition_id", F.col("category").alias("__new")), "condition_id", "left").withColumn("category", F.coalesce("__new", "category")).select("market_id", "condition_id", "category")
    slots = F.explode(F.array(F.struct(F.col("yes_token").alias("token_id"), (-(2 * F.col("market_id") - 1)).alias("id"), F.lit(0).alias("outcome_index")), F.struct(F.col("no_token").alias("token_id"), (-2 * F.col("market_id")).alias("id"), F.lit(1).alias("outcome_index"))))
    added = placed.select("market_id", slots.alias("t")).select("market_id", "t.*")
    return changed.unionByName(placed.select("market_id", "condition_id", "category")), tokens.select("market_id", "token_id", "id", "outcome_index").unionByName(added.select("market_id", "token_id", "id", "outcome_index")), conflicts


def recover_failures(ledger: DataFrame, latest: DataFrame, markets: DataFrame) -> DataFrame:
    """Ledger in which open failures are resolved whose latest payload of the same generation now normalises to a
    registered condition. ledger: failure_key, generation, status; latest: failure_key, generation, id, payload."""
    good = normalize_markets(latest.select(F.struct("failure_key", "generation").alias("id"), "payload"))[0]
    fixed = good.join(markets.select("condition_id").distinct(), "condition_id", "left_semi").select("id.failure_key", "id.generation").distinct().withColumn("__fixed", F.lit(True))
    out = ledger.join(fixed, ["failure_key", "generation"], "left")
    return out.withColumn("status", F.when((F.col("status") == "open") & F.col("__fixed"), "resolved").otherwise(F.col("status"))).select(*ledger.columns)


#: Rule pages of five-minute rounds, and what their wording must hold: fixed values.
RULE_URL, RULE_WORDS, ROUND_MS = "https://data.chain.link/streams/%s-usd-twap-60s-streams", ("greater than or equal to", "time-weighted average"), 300_000


def bind_rules(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bound rounds, others): rows asset, start_ms, end_ms, slug, source, description, version, condition_id, labels and
    tokens (arrays) bind if slug, end, rule page, wording, identity, labels and tokens all fit. The rule's version is a
    prefix of the description's hash."""
    asset = F.lower("asset")
    url = F.concat(F.lit(RULE_URL.split("%s")[0]), asset, F.lit(RULE_URL.split("%s")[1]))
    fits = (
        (F.col("slug") == F.concat(asset, F.lit("-updown-5m-"), F.floor(F.col("start_ms") / 1000).cast("string"))) & (F.col("end_ms") == F.col("start_ms") + ROUND_MS) & F.col("version").isin("v1", "v2")
        & (F.col("source") == url) & F.contains("description", url) & F.contains("description", F.lit(RULE_WORDS[0])) & F.contains("description", F.lit(RULE_WORDS[1])) & F.col("condition_id").rlike("^0x[0-9a-fA-F]{64}$")
        & (F.array_join(F.array_sort(F.transform("labels", F.upper)), ",") == "DOWN,UP") & (F.size(F.array_distinct("tokens")) == 2) & (F.size("tokens") == 2) & F.forall("tokens", lambda t: t.rlike("^[1-9][0-9]{0,77}$"))
    )
    marked = tables.settled(rows.withColumn("__fits", F.coalesce(fits, F.lit(False))))
    up = F.get("tokens", F.when(F.upper(F.get("labels", 0)) == "UP", 0).otherwise(1))
    down = F.get("tokens", F.when(F.upper(F.get("labels", 0)) == "UP", 1).otherwise(0))
    version = F.concat(F.lit("twap60:"), F.substring(F.sha2("description", 256), 1, 16))
    return marked.where("__fits").select("asset", "start_ms", "end_ms", "condition_id", up.alias("up_token"), down.alias("down_token"), version.alias("rule_version")), marked.where("not __fits").drop("__fits")
