"""Queries over dates, versions and histories.

Texts with dates are put together from columns, as the driver's tables have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions import dates, outline, text
from lexquarry.operators import joins, ranking
from lexquarry.plans.registry import Tables, query

# Parts of an order's date, under names that both engines have.
_Y, _M, _D = "year(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)"
_MONTH = "CASE month(o_orderdate) " + " ".join(f"WHEN {k} THEN '{m}'" for k, m in enumerate(dates.MONTHS, 1)) + " END"
_RAW = f"""CASE o_orderkey % 7 WHEN 0 THEN concat({_Y}, '-', {_M}, '-', {_D}) WHEN 1 THEN concat({_M}, '/', {_D}, '/', {_Y}) WHEN 2 THEN concat({_M}, '/', {_D}, '/', lpad(cast({_Y} % 100 as string), 2, '0'))
 WHEN 3 THEN 'soon' WHEN 4 THEN concat({_Y}, '-13-', {_D}) WHEN 5 THEN NULL ELSE concat(' ', {_Y}, '-', lpad(cast({_M} as string), 2, '0'), '-', lpad(cast({_D} as string), 2, '0'), ' ') END"""


def _iso(x: str) -> str:
    """SQL: a date of ISO text, null if there is no such day."""
    return f"TRY_CAST({x} AS DATE)"


def _flexible(c: str) -> str:
    part = lambda p, g: f"regexp_extract(trim({c}), '{p}', {g})"
    day = lambda y, m, d: _iso(f"{y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0')")
    iso, us, two = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$", r"^(\d{1,2})/(\d{1,2})/(\d\d)$"
    return "coalesce(" + ", ".join((day(part(iso, 1), part(iso, 2), part(iso, 3)), day(part(us, 3), part(us, 1), part(us, 2)), day(f"'20' || {part(two, 3)}", part(two, 1), part(two, 2)))) + ")"


def _text(d: str) -> str:
    return f"strftime({d}, '%Y-%m-%d')"


@query(f"SELECT o_orderkey, {_text(_flexible('r'))} AS day FROM (SELECT o_orderkey, {_RAW} AS r FROM orders)")
def flexible_dates(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.expr(_RAW).alias("r")).select("o_orderkey", dates.day_text(dates.flexible_date("r")).alias("day"))


_NOTE = f"""concat('Adopted ', {_MONTH}, ' ', {_D}, ', ', {_Y}, '; filed ', {_M}, '/', {_D}, '/', {_Y} + 1, ' and ', {_Y}, '-', lpad(cast({_M} as string), 2, '0'), '-', {_D} + 3, ', posted 2/30/1999.')"""
_MONTH_NO = f"list_position([{', '.join(repr(m) for m in dates.MONTHS)}], regexp_extract(c, '{dates.NAMED}', 1))"


def _day_of(y: str, m: str, d: str) -> str:
    return _iso(f"{y} || '-' || lpad({m}::VARCHAR, 2, '0') || '-' || lpad({d}, 2, '0')")


def _group(p: str, g: int) -> str:
    return f"regexp_extract(c, '{p}', {g})"


_ALL = f"""list_filter(list_concat(list_transform(regexp_extract_all(x, '{dates.ISO}'), lambda c: {_day_of(_group(dates.ISO, 1), _group(dates.ISO, 2), _group(dates.ISO, 3))}),
  list_transform(regexp_extract_all(x, '{dates.SLASHED}'), lambda c: {_day_of(_group(dates.SLASHED, 3), _group(dates.SLASHED, 1), _group(dates.SLASHED, 2))}),
  list_transform(regexp_extract_all(x, '{dates.NAMED}'), lambda c: {_day_of(_group(dates.NAMED, 3), _MONTH_NO, _group(dates.NAMED, 2))})), lambda d: d IS NOT NULL)"""


@query(f"WITH n AS (SELECT o_orderkey, {_NOTE} AS x FROM orders), d AS (SELECT o_orderkey, {_ALL} AS l FROM n) SELECT o_orderkey, len(l)::BIGINT AS n, {_text('list_max(l)')} AS latest, {_text('list_min(l)')} AS first FROM d")
def dates_in_text(t: Tables) -> DataFrame:
    found = t.orders.select("o_orderkey", dates.all_dates(F.expr(_NOTE)).alias("l"))
    return found.select("o_orderkey", F.size("l").cast("long").alias("n"), dates.day_text(F.array_max("l")).alias("latest"), dates.day_text(F.array_min("l")).alias("first"))


_EFFECTIVE = f"CASE o_orderkey % 4 WHEN 0 THEN concat('in force from ', {_MONTH}, ' ', {_D}, ', ', {_Y}) WHEN 1 THEN concat('effective ', {_Y}, '-', {_M}, '-', {_D}) WHEN 2 THEN concat('for fiscal year ', {_Y}) ELSE 'upon signature' END"


@query(f"""
WITH e AS (SELECT o_orderkey, {_EFFECTIVE} AS c FROM orders)
SELECT o_orderkey, {_text('coalesce(' + ', '.join((_day_of(_group(dates.ISO, 1), _group(dates.ISO, 2), _group(dates.ISO, 3)), _day_of(_group(dates.NAMED, 3), _MONTH_NO, _group(dates.NAMED, 2)),
  "make_date(TRY_CAST(regexp_extract(c, '" + dates.FISCAL + "', 1) AS BIGINT) - 1, 7, 1)")) + ')')} AS day FROM e""")
def stated_dates(t: Tables) -> DataFrame:
    """Effective dates of acts: a date, or the fiscal year's first day."""
    return t.orders.select("o_orderkey", F.expr(_EFFECTIVE).alias("c")).select("o_orderkey", dates.day_text(dates.stated_date("c")).alias("day"))


@query("""
WITH s AS (SELECT o_orderpriority AS source, CASE o_orderpriority WHEN '1-URGENT' THEN 30 WHEN '2-HIGH' THEN 90 ELSE 365 END AS policy, max(o_orderdate)::DATE AS last, CASE WHEN o_orderpriority = '5-LOW' THEN 12 END AS stated FROM orders GROUP BY 1)
SELECT source, coalesce(stated, date_diff('day', last, DATE '1999-01-01'))::BIGINT AS staleness, CASE WHEN coalesce(stated, date_diff('day', last, DATE '1999-01-01')) > policy THEN 'stale' ELSE 'current' END AS status FROM s""")
def policy_freshness(t: Tables) -> DataFrame:
    """Each source against the days its own policy allows; a stated age goes before the one counted."""
    last = t.orders.groupBy(F.col("o_orderpriority").alias("source")).agg(F.max("o_orderdate").cast("date").alias("last"))
    policy = text.ladder((F.col("source") == "1-URGENT", 30), (F.col("source") == "2-HIGH", 90), otherwise=365)
    age = F.coalesce(F.when(F.col("source") == "5-LOW", 12), F.datediff(F.lit("1999-01-01").cast("date"), "last"))
    return last.select("source", age.cast("long").alias("staleness"), F.when(age > policy, "stale").otherwise("current").alias("status"))


_ASK = f"CASE o_orderkey % 3 WHEN 0 THEN concat('What held as of ', {_Y}, '-', lpad(cast({_M} as string), 2, '0'), '-', lpad(cast({_D} as string), 2, '0'), '?') WHEN 1 THEN 'What was the former rule?' ELSE 'What is the rule?' END"


@query(rf"""
WITH a AS (SELECT o_orderkey, {_ASK} AS q FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(q, '(?i)as of \d{{4}}-\d\d-\d\d') THEN 'as_of' WHEN regexp_matches(q, '(?i)\b(former|historical|previous)\b') THEN 'historical' ELSE 'current' END AS scope,
  nullif(regexp_extract(q, '(?i)as of (\d{{4}}-\d\d-\d\d)', 1), '') AS day FROM a""")
def as_of_scope(t: Tables) -> DataFrame:
    """Does a request speak of a day, of former law, or of today's?"""
    q, day = F.col("q"), r"(?i)as of (\d{4}-\d\d-\d\d)"
    scope = text.ladder((q.rlike(day), "as_of"), (q.rlike(r"(?i)\b(former|historical|previous)\b"), "historical"), otherwise="current")
    return t.orders.select("o_orderkey", F.expr(_ASK).alias("q")).select("o_orderkey", scope.alias("scope"), F.nullif(F.regexp_extract(q, day, 1), F.lit("")).alias("day"))


_HELD = f"CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'v2' ELSE concat({_M}, '/', {_D}, '/', 1995) END"


@query(f"""
WITH m AS (SELECT o_orderkey, {_RAW} AS observed, {_HELD} AS held FROM orders)
SELECT o_orderkey, CASE WHEN observed IS NULL THEN false WHEN held IS NULL THEN true WHEN {_flexible('observed')} IS NOT NULL AND {_flexible('held')} IS NOT NULL
  THEN {_flexible('observed')} > {_flexible('held')} ELSE trim(observed) <> trim(held) END AS newer FROM m""")
def newer_markers(t: Tables) -> DataFrame:
    m = t.orders.select("o_orderkey", F.expr(_RAW).alias("observed"), F.expr(_HELD).alias("held"))
    return m.select("o_orderkey", dates.newer(F.col("observed"), F.col("held")).alias("newer"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events")
def entity_timeline(t: Tables) -> DataFrame:
    """Events of each entity in the order of date and id."""
    return ranking.numbered(t.events.select("user_id", "event_id", "ts"), "user_id", F.col("ts"), F.col("event_id")).select("user_id", "event_id", F.col("rank").alias("place"))


_PAGE = """concat('Rule ', s_suppkey, '\nHistory\nAdopted 3/', s_suppkey % 28 + 1, '/1999 in full\nno date here\nAmended ', s_suppkey % 12 + 1, '/2/2004\nNotes\nAdopted 1/1/1990')"""
_SLASHED = r"(\d{1,2})/(\d{1,2})/(\d{4})"


def _history(t: Tables) -> DataFrame:
    """Lines behind the heading, up to the next one, that state a date."""
    texts = t.supplier.select("s_suppkey", F.expr(_PAGE).alias("x"))
    found = outline.outline(texts, "s_suppkey", "x", outline.Shape((("heading", "^(History|Notes)$"),))).where("heading = 'History'")
    lines = found.select("s_suppkey", F.explode(F.split("body", "\n")).alias("line"))
    kind = F.lower(F.regexp_extract("line", r"^(\w+)", 1))
    day = dates.flexible_date(F.nullif(F.regexp_extract("line", _SLASHED, 0), F.lit("")))
    return lines.select("s_suppkey", kind.alias("kind"), day.alias("day")).where("day IS NOT NULL")


_HISTORY_SQL = rf"""l AS (SELECT s_suppkey, i, s[i] AS line, s FROM (SELECT s_suppkey, string_split({_PAGE}, chr(10)) AS s, unnest(range(1, len(string_split({_PAGE}, chr(10))) + 1)) AS i FROM supplier)),
 h AS (SELECT s_suppkey, lower(regexp_extract(line, '^(\w+)', 1)) AS kind, {_flexible(f"regexp_extract(line, '{_SLASHED}', 0)")} AS day FROM l
       WHERE i > list_position(s, 'History') AND i < list_position(s, 'Notes') AND regexp_matches(line, '{_SLASHED}'))"""


@query(f"WITH {_HISTORY_SQL} SELECT s_suppkey, kind, {_text('day')} AS day FROM h")
def history_events(t: Tables) -> DataFrame:
    return _history(t).select("s_suppkey", "kind", dates.day_text("day").alias("day"))


@query(f"""
WITH {_HISTORY_SQL}, v AS (SELECT s_suppkey, kind, day, false AS current FROM h UNION ALL SELECT s_suppkey, 'current', max(day), true FROM h GROUP BY 1)
SELECT s_suppkey, kind, {_text('day')} AS day, current, row_number() OVER (PARTITION BY s_suppkey ORDER BY day, current) AS version FROM v""")
def version_history(t: Tables) -> DataFrame:
    """A row for each event and one for the document of today, dated by its last event."""
    h = _history(t)
    today = h.groupBy("s_suppkey").agg(F.max("day").alias("day")).select("s_suppkey", F.lit("current").alias("kind"), "day", F.lit(True).alias("current"))
    rows = h.withColumn("current", F.lit(False)).unionByName(today)
    version = F.row_number().over(Window.partitionBy("s_suppkey").orderBy("day", "current"))  # the versions of one text
    return rows.select("s_suppkey", "kind", dates.day_text("day").alias("day"), "current", version.cast("long").alias("version"))


@query("""
WITH n AS (SELECT event_id, user_id, ts::DATE AS day FROM events), v AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, o_orderstatus = 'O' AS current FROM orders),
 s AS (SELECT k, max(day) AS last, bool_or(current) AS some FROM v GROUP BY 1), e AS (SELECT DISTINCT k, day FROM v)
SELECT event_id, CASE WHEN e.k IS NOT NULL THEN 'exact_date' WHEN s.some THEN 'current_document' WHEN s.k IS NOT NULL THEN 'last_version' ELSE 'none' END AS method,
 CASE WHEN e.k IS NOT NULL THEN 0.92 WHEN s.some THEN 0.62 WHEN s.k IS NOT NULL THEN 0.55 ELSE 0.0 END::DOUBLE AS confidence
FROM n LEFT JOIN e ON n.user_id = e.k AND n.day = e.day LEFT JOIN s ON n.user_id = s.k""")
def notice_versions(t: Tables) -> DataFrame:
    """Each notice with the best evidence of a version: one of its day, the document of today, or the last one."""
    n = t.events.select("event_id", F.col("user_id").alias("k"), F.col("ts").cast("date").alias("day"))
    v = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("day"), (F.col("o_orderstatus") == "O").alias("current"))
    some = v.groupBy("k").agg(F.bool_or("current").alias("some"))
    found = n.join(v.select("k", "day", F.lit(True).alias("exact")).distinct(), ["k", "day"], "left").join(some, "k", "left")
    steps = ((F.col("exact").isNotNull(), "exact_date", 0.92), (F.col("some"), "current_document", 0.62), (F.col("some").isNotNull(), "last_version", 0.55))
    return found.select(
        "event_id", text.ladder(*((c, m) for c, m, _ in steps), otherwise="none").alias("method"), text.ladder(*((c, x) for c, _, x in steps), otherwise=0.0).cast("double").alias("confidence")
    )


@query("""
WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS cls, CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN DATE '1900-01-01' ELSE l_shipdate::DATE END AS day FROM lineitem)
SELECT l_partkey, arg_max(l_orderkey, (cls, day, l_orderkey, l_linenumber)) AS l_orderkey, max(cls)::BIGINT AS version_class FROM r GROUP BY l_partkey""")
def ranked_versions(t: Tables) -> DataFrame:
    """The best version of each part: dated ones before undated, these before those that were to end; then by date and place."""
    r, o = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", text.ladder((r, 0), (o, 1), otherwise=2).alias("cls"), F.when(r | o, F.lit("1900-01-01").cast("date")).otherwise(F.col("l_shipdate").cast("date")).alias("day"))
    best = F.max_by("l_orderkey", F.struct("cls", "day", "l_orderkey", "l_linenumber"))
    return rows.groupBy("l_partkey").agg(best.alias("l_orderkey"), F.max("cls").cast("long").alias("version_class"))


@query("""
WITH now AS (SELECT c_custkey, sha256(concat(c_name, c_mktsegment)) AS sha FROM customer), prior AS (SELECT c_custkey, sha256(concat(c_name, CASE WHEN c_custkey % 3 = 0 THEN 'OTHER' ELSE c_mktsegment END)) AS sha, '2024-05-01' AS updated FROM customer WHERE c_custkey % 4 <> 0)
SELECT now.c_custkey, CASE WHEN now.sha = prior.sha THEN prior.updated ELSE '2025-01-01' END AS updated FROM now LEFT JOIN prior ON now.c_custkey = prior.c_custkey""")
def stable_timestamps(t: Tables) -> DataFrame:
    """Rows keep the time of their last change while their digest stays the same."""
    now = t.customer.select("c_custkey", F.sha2(F.concat("c_name", "c_mktsegment"), 256).alias("sha"))
    before = F.when(F.col("c_custkey") % 3 == 0, "OTHER").otherwise(F.col("c_mktsegment"))
    prior = t.customer.where("c_custkey % 4 <> 0").select("c_custkey", F.sha2(F.concat("c_name", before), 256).alias("sha"), F.lit("2024-05-01").alias("updated"))
    return joins.kept_times(now, prior, "c_custkey", "sha", "updated", F.lit("2025-01-01"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'pending_review' WHEN o_orderkey % 6 = 1 THEN 'probe_failed' WHEN o_orderkey % 6 = 2 THEN 'not_observed' WHEN o_totalprice > 150000 THEN 'changed' ELSE 'unchanged' END AS status FROM orders""")
def change_watch(t: Tables) -> DataFrame:
    k, price = F.col("o_orderkey") % 6, F.col("o_totalprice")
    return t.orders.select("o_orderkey", text.ladder((k == 0, "pending_review"), (k == 1, "probe_failed"), (k == 2, "not_observed"), (price > 150000, "changed"), otherwise="unchanged").alias("status"))
