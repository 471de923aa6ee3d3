"""Queries over obligations and bills, on prose put together from columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexquarry.functions import legal, outline, text, units
from lexquarry.plans.registry import Tables, query

PROSE = """concat('The owner of a ', p_brand, ' unit shall file a report with the office within ', p_size, ' days if the ', p_type, ' part is sold, unless exempted by rule; ',
 CASE p_partkey % 4 WHEN 0 THEN 'No dealer may sell it before the first of May, except as provided by law. ' WHEN 1 THEN 'It must be kept. ' WHEN 2 THEN 'Each permit is required to be shown annually when asked for. ' ELSE 'Parts are counted. ' END,
 'Records must not be destroyed, provided that copies are kept.')"""
_SENTENCES = "string_split(regexp_replace(x, '([.;])\\s+', '\\1' || chr(1), 'g'), chr(1))"
_X = f"x AS (SELECT p_partkey, {PROSE} AS x FROM part), s AS (SELECT p_partkey, i - 1 AS pos, s[i] AS s FROM (SELECT p_partkey, {_SENTENCES} AS s, unnest(range(1, len({_SENTENCES}) + 1)) AS i FROM x))"


def _prose(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(PROSE).alias("x"))


def _sentences(t: Tables) -> DataFrame:
    return _prose(t).select("p_partkey", F.posexplode(F.split(F.regexp_replace("x", r"([.;])\s+", "$1\u0001"), "\u0001")).alias("pos", "s"))


def _part(g: int) -> str:
    return f"trim(regexp_extract(s, '{legal.ACTION}', {g}))"


@query(f"WITH {_X} SELECT p_partkey, pos, {_part(1)} AS subject, lower({_part(2)}) AS modal, {_part(3)} AS rest FROM s WHERE {_part(2)} <> ''")
def rule_actions(t: Tables) -> DataFrame:
    found = _sentences(t).select("p_partkey", F.col("pos").cast("long").alias("pos"), units.action("s").alias("a"))
    return found.where("a.modal <> ''").select("p_partkey", "pos", "a.*")


@query(f"""
WITH {_X}, c AS (SELECT p_partkey, list_transform(regexp_extract_all(x, '{legal.CLAUSE}'), lambda c: trim(c)) AS c, nullif(trim(regexp_extract(x, '{legal.TEMPORAL}', 0)), '') AS temporal FROM x)
SELECT p_partkey, array_to_string(list_filter(c, lambda x: NOT regexp_matches(x, '{units.EXCEPTIONS}')), '|') AS conditions, array_to_string(list_filter(c, lambda x: regexp_matches(x, '{units.EXCEPTIONS}')), '|') AS exceptions, temporal FROM c""")
def rule_clauses(t: Tables) -> DataFrame:
    """Conditions, exceptions and the first phrase of time of each text."""
    return _prose(t).select("p_partkey", F.array_join(units.clauses("x", False), "|").alias("conditions"), F.array_join(units.clauses("x", True), "|").alias("exceptions"), units.temporal("x").alias("temporal"))


_VAGUE = ", ".join(f"'{v}'" for v in units.VAGUE)


@query(f"""
WITH {_X}, a AS (SELECT p_partkey, pos, {_part(1)} AS subject FROM s WHERE {_part(2)} <> '')
SELECT p_partkey, pos, subject FROM a WHERE length(subject) >= 4 AND lower(subject) NOT IN ({_VAGUE}) AND NOT regexp_matches(lower(subject), '{'|'.join(units.FRONT_MATTER)}') AND regexp_matches(subject, '[A-Za-z]')""")
def fit_subjects(t: Tables) -> DataFrame:
    """Units whose subject says who is meant."""
    return rule_actions(t).where(units.fit_subject(F.col("subject"))).select("p_partkey", "pos", "subject")


#: Keywords of the example, by pattern.
KEYWORDS = {"filing": r"\bfile\b", "permit": r"\bpermit\b", "records": r"\brecords?\b", "sale": r"\bs(?:ell|old)\b"}


@query(f"""
WITH {_X} SELECT p_partkey, array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN regexp_matches(lower(x), '{p}') THEN '{k}' END" for k, p in KEYWORDS.items())}], lambda k: k IS NOT NULL)), '|') AS keywords FROM x""")
def compliance_keywords(t: Tables) -> DataFrame:
    hits = F.filter(F.array(*(F.when(F.lower("x").rlike(p), F.lit(k)) for k, p in KEYWORDS.items())), lambda k: k.isNotNull())
    return _prose(t).select("p_partkey", F.array_join(F.array_sort(hits), "|").alias("keywords"))


@query(f"""
WITH {_X} SELECT p_partkey, array_to_string(list_filter({_SENTENCES}, lambda s: NOT (contains(lower(s), 'unless') OR contains(lower(s), lower('Records')))), ' ') AS body,
  CASE WHEN p_partkey % 3 = 0 THEN x ELSE regexp_replace(x, '(?i)\\bNo dealer\\b', 'No dealer that was found', 'g') END AS hedged FROM x""")
def sentence_removal(t: Tables) -> DataFrame:
    """Texts without the sentences of listed terms; and statements of absence put as what was found, where no evidence is there."""
    hedged = F.when(F.col("p_partkey") % 3 == 0, F.col("x")).otherwise(F.regexp_replace("x", r"(?i)\bNo dealer\b", "No dealer that was found"))
    return _prose(t).select("p_partkey", legal.kept_sentences(F.col("x"), F.array(F.lit("unless"), F.lit("Records"))).alias("body"), hedged.alias("hedged"))


@query(f"""
WITH {_X}, p AS (SELECT p_partkey, list_filter(list_transform(string_split(x, ';'), lambda c: trim(c)), lambda c: regexp_matches(lower(c), '\\b(shall|must|may|required)\\b')) AS p FROM x)
SELECT p_partkey, i - 1 AS part, p[i] AS body FROM (SELECT p_partkey, p, unnest(range(1, len(p) + 1)) AS i FROM p WHERE len(p) > 1)""")
def split_proposals(t: Tables) -> DataFrame:
    """Texts of several obligations cut at semicolons, where more than one part keeps a modal verb."""
    parts = F.filter(F.transform(F.split("x", ";"), lambda c: F.trim(c)), lambda c: F.lower(c).rlike(r"\b(shall|must|may|required)\b"))
    rows = _prose(t).select("p_partkey", parts.alias("p")).where(F.size("p") > 1)
    return rows.select("p_partkey", F.posexplode("p").alias("part", "body")).select("p_partkey", F.col("part").cast("long").alias("part"), "body")


@query(f"WITH {_X} SELECT p_partkey, pos, trim(regexp_extract(s, '(?i)^(?:the |each |no )?(.*?) (?:shall|must|may)\\b', 1)) AS entity FROM s WHERE regexp_matches(s, '(?i) (?:shall|must|may)\\b')")
def entity_phrases(t: Tables) -> DataFrame:
    """Who is addressed: the words before the modal verb, without an article."""
    rows = _sentences(t).where(F.col("s").rlike(r"(?i) (?:shall|must|may)\b"))
    return rows.select("p_partkey", F.col("pos").cast("long").alias("pos"), F.trim(F.regexp_extract("s", r"(?i)^(?:the |each |no )?(.*?) (?:shall|must|may)\b", 1)).alias("entity"))


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, lower(l_returnflag || '/' || l_partkey % 5) AS k FROM lineitem), f AS (SELECT l_orderkey, k, min((l_linenumber, l_partkey)) AS first FROM a GROUP BY 1, 2),
 n AS (SELECT l_orderkey, k, row_number() OVER (PARTITION BY l_orderkey ORDER BY first, k) AS seq FROM f) SELECT l_orderkey, k AS action, seq FROM n WHERE seq <= 24""")
def distinct_actions(t: Tables) -> DataFrame:
    """Actions of each document, distinct case aside, numbered by first place; the first 24, as the feature asks."""
    a = t.lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey").alias("at"), F.lower(F.concat_ws("/", "l_returnflag", (F.col("l_partkey") % 5).cast("string"))).alias("action"))
    first = a.groupBy("l_orderkey", "action").agg(F.min("at").alias("at"))
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("at", "action"))  # the actions of one document
    return first.withColumn("seq", seq.cast("long")).where("seq <= 24").select("l_orderkey", "action", "seq")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0.62 ELSE 0.62 + 0.08 END::DOUBLE + CASE WHEN l_quantity >= 25 THEN 0.04 ELSE 0 END + CASE WHEN l_discount > 0.05 THEN 0.03 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 0.03 ELSE 0 END::DOUBLE AS confidence FROM lineitem""")
def unit_confidence(t: Tables) -> DataFrame:
    """A unit's confidence: .62, and more for a known type, a subject of two words, tags and a citation; .82 at most."""
    add = ((F.col("l_returnflag") != "N", 8), (F.col("l_quantity") >= 25, 4), (F.col("l_discount") > 0.05, 3), (F.col("l_linestatus") == "O", 3))
    points = sum((F.when(c, n).otherwise(0) for c, n in add), F.lit(62))
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.least(points, F.lit(82)) / 100).cast("double").alias("confidence"))


# ---- pages and sections -----------------------------------------------------

LAW = """concat('#### 1-', s_suppkey, '\nFirst text\n12\nPage footer\n#### 2-', s_suppkey, '\nDefinitions of things\nmore\n#### 3-', s_suppkey, '\nThird text of ', s_name)"""


@query(f"""SELECT s_suppkey, trim(regexp_extract({LAW}, '(?s)#### 2-' || s_suppkey || chr(10) || '(.*?)(?:' || chr(10) || '#### |$)', 1)) AS body FROM supplier""")
def section_by_key(t: Tables) -> DataFrame:
    """The lines under a section's heading."""
    texts = t.supplier.select("s_suppkey", F.expr(LAW).alias("x"))
    found = outline.outline(texts, "s_suppkey", "x", outline.Shape((("section", "^#### (.*)"),)))
    return found.where(F.col("heading") == F.concat(F.lit("2-"), F.col("s_suppkey"))).select("s_suppkey", F.trim("body").alias("body"))


@query(f"""
WITH l AS (SELECT s_suppkey, string_split({LAW}, chr(10)) AS s FROM supplier), r AS (SELECT s_suppkey, i, s[i] AS line, list_filter(s[1:i], lambda x: starts_with(x, '#### '))[-1] AS head FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l))
SELECT s_suppkey, substring(head, 6) AS section, string_agg(line, ' ' ORDER BY i) AS body FROM r WHERE NOT starts_with(line, '#### ') AND NOT regexp_matches(line, '^\\d+$') AND line <> 'Page footer' AND NOT regexp_matches(lower(line), '^(definitions|purpose|authority)') GROUP BY 1, 2""")
def clean_sections(t: Tables) -> DataFrame:
    """Sections without page numbers, footers and lines of definition."""
    texts = t.supplier.select("s_suppkey", F.expr(LAW).alias("x"))
    noise = r"^\d+$|^Page footer$|(?i:^(definitions|purpose|authority))"
    found = outline.outline(texts, "s_suppkey", "x", outline.Shape((("section", "^#### (.*)"),), noise=noise, joint=" ")).where("n_lines > 0")
    return found.select("s_suppkey", F.col("heading").alias("section"), "body")


NUMBERED = """concat('1 An act\n2 concerning things\n', s_suppkey, ' parts are counted\n3 and kept\nplain line\n4 at the end\n1 Next page\n2 goes on')"""


@query(f"""
WITH l AS (SELECT s_suppkey, string_split({NUMBERED}, chr(10)) AS s FROM supplier), n AS (SELECT s_suppkey, i, s[i] AS line, TRY_CAST(regexp_extract(s[i], '^(\\d{{1,3}}) ', 1) AS INT) AS k FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM l)),
 p AS (SELECT *, lag(k) OVER (PARTITION BY s_suppkey ORDER BY i) AS before1, lag(k, 2) OVER (PARTITION BY s_suppkey ORDER BY i) AS before2, lead(k) OVER (PARTITION BY s_suppkey ORDER BY i) AS after1 FROM n)
SELECT s_suppkey, i - 1 AS pos, CASE WHEN k <= 200 AND (k = coalesce(before1, before2, 0) + 1 OR k = 1 OR k + 1 = after1) THEN regexp_replace(line, '^\\d{{1,3}} ', '') ELSE line END AS line FROM p""")
def unnumbered_lines(t: Tables) -> DataFrame:
    """Lines without the numbers a printer gave them: those that go on from the number before, start anew or lead to the next."""
    order = Window.partitionBy("s_suppkey").orderBy("i")  # the lines of one text
    lines = t.supplier.select("s_suppkey", F.posexplode(F.split(F.expr(NUMBERED), "\n")).alias("i", "line"))
    n = lines.withColumn("k", F.regexp_extract("line", r"^(\d{1,3}) ", 1).try_cast("int"))
    before, after = F.coalesce(F.lag("k").over(order), F.lag("k", 2).over(order), F.lit(0)), F.lead("k").over(order)
    stamped = F.coalesce((F.col("k") <= 200) & ((F.col("k") == before + 1) | (F.col("k") == 1) | (F.col("k") + 1 == after)), F.lit(False))
    return n.select("s_suppkey", F.col("i").cast("long").alias("pos"), F.when(stamped, F.regexp_replace("line", r"^\d{1,3} ", "")).otherwise(F.col("line")).alias("line"))


# ---- bills ------------------------------------------------------------------

BILL = """concat('BY REPRESENTATIVES Smith (D) and Jones; SENATOR Lee, also smith\nSECTION 1. In section ', p_size, '-1-101, the law is amended. There is appropriated $1,', 100 + p_partkey % 900, ' from the general fund and 2.5 FTE.\nSECTION 2. A part is hereby repealed. Whoever sells commits a class ', p_partkey % 6 + 1,
 ' felony and a fine of $5,000.\nSECTION 3. Effective date. This act takes effect July 1, 20', 10 + p_partkey % 20, '. The Committee on ', p_brand, ' reports.')"""


def _bill(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.expr(BILL).alias("x"))


_B = f"b AS (SELECT p_partkey, {BILL} AS x FROM part)"
_SECTIONS = f"{_B}, q AS (SELECT p_partkey, unnest(string_split(x, chr(10) || 'SECTION ')[2:]) AS q FROM b)"


@query(f"""
WITH {_SECTIONS}, h AS (SELECT p_partkey, regexp_extract(q, '^(\\d+)\\.', 1)::BIGINT AS number, trim(regexp_replace(q, '^\\d+\\.', '')) AS body FROM q)
SELECT p_partkey, number, body, CASE {' '.join(f"WHEN regexp_matches(lower(substring(body, 1, 1200)), '{p}') THEN '{name}'" for name, p in units.SECTION_ACTIONS)} ELSE 'other' END AS action, array_to_string(regexp_extract_all(body, '{legal.CRS}'), '|') AS refs FROM h""")
def bill_sections(t: Tables) -> DataFrame:
    """Numbered sections of bills with what they do and cite."""
    q = _bill(t).select("p_partkey", F.explode(text.all_but_first(F.split("x", "\nSECTION "))).alias("q"))
    h = q.select("p_partkey", F.regexp_extract("q", r"^(\d+)\.", 1).cast("long").alias("number"), F.trim(F.regexp_replace("q", r"^\d+\.", "")).alias("body"))
    return h.select("*", units.section_action(F.col("body")).alias("action"), F.array_join(F.regexp_extract_all("body", F.lit(legal.CRS), F.lit(0)), "|").alias("refs"))


@query(f"""
WITH {_B}, n AS (SELECT p_partkey, regexp_extract(x, '^BY ([^\\n]*)', 1) AS n FROM b), c AS (SELECT p_partkey, list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(regexp_replace(n, '\\([^)]*\\)', ' ', 'g'), '{units.HONORIFICS}', ' ', 'g'), '(?i)\\b(?:and|with|also)\\b', ',', 'g'), '[,;]+'),
  lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS c FROM n)
SELECT p_partkey, array_to_string(list_filter(c, lambda x, i: list_position(list_transform(c, lambda y: lower(y)), lower(x)) = i), '|') AS sponsors FROM c""")
def bill_sponsors(t: Tables) -> DataFrame:
    return _bill(t).select("p_partkey", F.array_join(units.sponsors(F.regexp_extract("x", r"^BY ([^\n]*)", 1)), "|").alias("sponsors"))


@query(f"""
WITH {_B} SELECT p_partkey, array_to_string(regexp_extract_all(x, '{units.MONEY}'), '|') AS amounts, lower(nullif(regexp_extract(x, '{units.FUND}', 1), '')) AS fund, TRY_CAST(regexp_extract(x, '{units.STAFF}', 1) AS DOUBLE) AS staff FROM b""")
def bill_money(t: Tables) -> DataFrame:
    """Amounts, the first fund named, and posts."""
    fund = F.lower(F.nullif(F.regexp_extract("x", units.FUND, 1), F.lit("")))
    return _bill(t).select("p_partkey", F.array_join(F.regexp_extract_all("x", F.lit(units.MONEY), F.lit(0)), "|").alias("amounts"), fund.alias("fund"), F.regexp_extract("x", units.STAFF, 1).try_cast("double").alias("staff"))


@query(f"""
WITH {_B}, a AS (SELECT p_partkey, x, regexp_extract_all(x, '{units.MONEY}') AS m FROM b), u AS (SELECT p_partkey, x, unnest(list_distinct(m)) AS amount FROM a), w AS (SELECT p_partkey, amount, substring(x, greatest(1, instr(x, amount) - 110), 220) AS near FROM u)
SELECT p_partkey, amount, lower(nullif(regexp_extract(near, '{units.FUND}', 1), '')) AS fund FROM w WHERE regexp_matches(lower(near), '\\bappropriat')""")
def appropriations(t: Tables) -> DataFrame:
    """Amounts that are appropriated, with the fund named within 220 characters."""
    u = _bill(t).select("p_partkey", "x", F.explode(F.array_distinct(F.regexp_extract_all("x", F.lit(units.MONEY), F.lit(0)))).alias("amount"))
    near = F.expr("substring(x, greatest(1, locate(amount, x) - 110), 220)")
    w = u.select("p_partkey", "amount", near.alias("near")).where(F.lower("near").rlike(r"\bappropriat"))
    return w.select("p_partkey", "amount", F.lower(F.nullif(F.regexp_extract("near", units.FUND, 1), F.lit(""))).alias("fund"))


@query(f"""
WITH {_B} SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(x, '{units.PENALTY}'), lambda c: lower(c)), '|') AS penalties, trim(coalesce(nullif(regexp_extract(x, '(?i)Effective date\\.\\s*([^.]*\\d{{4}})', 1), ''), nullif(regexp_extract(x, '(?i)(this act takes effect[^.]*)', 1), ''))) AS effective FROM b""")
def bill_clauses(t: Tables) -> DataFrame:
    """Penalties, and the clause of the effective date: under its heading, else by its sentence."""
    first = lambda p: F.nullif(F.regexp_extract("x", p, 1), F.lit(""))
    penalties = F.transform(F.regexp_extract_all("x", F.lit(units.PENALTY), F.lit(0)), lambda c: F.lower(c))
    effective = F.coalesce(first(r"(?i)Effective date\.\s*([^.]*\d{4})"), first(r"(?i)(this act takes effect[^.]*)"))
    return _bill(t).select("p_partkey", F.array_join(penalties, "|").alias("penalties"), F.trim(effective).alias("effective"))


@query(f"""
WITH {_B}, c AS (SELECT DISTINCT p_brand AS name FROM part WHERE p_size <= 10), m AS (SELECT p_partkey, trim(regexp_extract(x, 'Committee on ([A-Za-z0-9#, ]+?) reports', 1)) AS said FROM b)
SELECT p_partkey, said, c.name AS committee, CASE WHEN lower(said) = lower(c.name) THEN 'exact' ELSE 'contained' END AS method FROM m JOIN c ON contains(lower(said), lower(c.name))""")
def committee_mentions(t: Tables) -> DataFrame:
    """Committees that a text names: the very name, or one that holds a known name."""
    known = F.broadcast(t.part.where("p_size <= 10").select(F.col("p_brand").alias("committee")).distinct())  # a code list of some 25 names
    m = _bill(t).select("p_partkey", F.trim(F.regexp_extract("x", "Committee on ([A-Za-z0-9#, ]+?) reports", 1)).alias("said"))
    found = m.join(known, F.lower("said").contains(F.lower("committee")))
    return found.select("p_partkey", "said", "committee", F.when(F.lower("said") == F.lower("committee"), "exact").otherwise("contained").alias("method"))


_GLOSSARY = """concat('"Dealer" means one who sells ', p_type, '. "Unit" means a ', p_brand, '. "dealer" means any other.')"""


@query(f"""
WITH g AS (SELECT p_partkey, {_GLOSSARY} AS x FROM part), a AS (SELECT p_partkey, regexp_extract_all(x, '"([^"]+)" means ([^.]+)', 1) AS terms, regexp_extract_all(x, '"([^"]+)" means ([^.]+)', 2) AS meanings FROM g), u AS (SELECT p_partkey, i, terms[i] AS term, meanings[i] AS meaning FROM (SELECT *, unnest(range(1, len(terms) + 1)) AS i FROM a))
SELECT p_partkey, lower(term) AS term, arg_min(meaning, i) AS meaning FROM u GROUP BY 1, 2""")
def definitions(t: Tables) -> DataFrame:
    """Terms with their first meaning, case aside."""
    pattern = F.lit('"([^"]+)" means ([^.]+)')
    g = t.part.select("p_partkey", F.expr(_GLOSSARY).alias("x"))
    pairs = F.arrays_zip(F.regexp_extract_all("x", pattern, F.lit(1)).alias("term"), F.regexp_extract_all("x", pattern, F.lit(2)).alias("meaning"))
    u = g.select("p_partkey", F.posexplode(pairs).alias("i", "p"))
    return u.groupBy("p_partkey", F.lower("p.term").alias("term")).agg(F.min_by("p.meaning", "i").alias("meaning"))


# ---- quality of texts -------------------------------------------------------

_BROKEN = "CASE page_id % 3 WHEN 0 THEN concat(html, chr(65533)) WHEN 1 THEN concat(html, 'Ã©Ã¨', chr(65533)) ELSE html END"


@query(f"WITH b AS (SELECT page_id, {_BROKEN} AS x FROM pages) SELECT page_id, length(x) - length(replace(x, chr(65533), '')) AS replaced, len(regexp_extract_all(x, 'Ã[©¨]'))::BIGINT AS garbled FROM b")
def text_markers(t: Tables) -> DataFrame:
    """Signs of texts read in the wrong encoding, wherever they stand in a page."""
    x = F.expr(_BROKEN.replace("chr(65533)", "'�'"))
    return t.pages.select("page_id", x.alias("x")).select("page_id", (F.length("x") - F.length(F.replace("x", F.lit("�"), F.lit("")))).cast("long").alias("replaced"), F.regexp_count("x", F.lit("Ã[©¨]")).cast("long").alias("garbled"))


_MAGIC = "CASE p_partkey % 4 WHEN 0 THEN '255044462D312E34' WHEN 1 THEN '504B030414000600' WHEN 2 THEN 'D0CF11E0A1B11AE1' ELSE '3C68746D6C3E' END"


@query(f"SELECT p_partkey, CASE WHEN starts_with(m, '25504446') THEN 'pdf' WHEN starts_with(m, '504B0304') THEN 'docx' WHEN starts_with(m, 'D0CF11E0') THEN 'doc' ELSE 'unknown' END AS format FROM (SELECT p_partkey, {_MAGIC} AS m FROM part)")
def file_formats(t: Tables) -> DataFrame:
    """Formats by the first bytes of a file."""
    head = F.hex(F.substring(F.unhex(F.expr(_MAGIC)), 1, 4))
    kind = text.ladder((F.col("h") == "25504446", "pdf"), (F.col("h") == "504B0304", "docx"), (F.col("h") == "D0CF11E0", "doc"), otherwise="unknown")
    return t.part.select("p_partkey", head.alias("h")).select("p_partkey", kind.alias("format"))
