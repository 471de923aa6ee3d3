"""Queries over citations and identifiers: canonical forms, terms, evidence and pages.

The driver's tables hold no citations, so the texts are put together from columns of ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.functions import legal, outline, text
from lexquarry.operators import ranking
from lexquarry.plans.registry import Tables, query

CITED = """concat('Under section ', lpad(cast(p_partkey % 48 as string), 3, '0'), '-', p_size, '-', 100 + p_partkey % 50, '.', p_partkey % 4, '0, C.R.S., "Large ', p_brand,
 '" means a thing of ', p_type, '; "item" means any. See ', p_partkey % 12 + 1, ' CCR ', 200 + p_size, '-', p_partkey % 9 + 1, ' and 40 CFR ', p_size, '.', p_partkey % 7,
 '. See also 24-', p_size, '-', 100 + p_partkey % 3, ' and 7 U.S.C. ', p_partkey % 100)"""
_CRS_SQL, _CCR_SQL = legal.CRS, legal.CCR


def _cited(t: Tables, *more: str) -> DataFrame:
    return t.part.select("p_partkey", *more, F.expr(CITED).alias("x"))


def _seg(p: str) -> str:
    return f"CASE WHEN contains({p}, '.') THEN string_split({p}, '.')[1]::INT || '.' || CASE WHEN rtrim(string_split({p}, '.')[2], '0') = '' THEN '0' ELSE rtrim(string_split({p}, '.')[2], '0') END ELSE ({p}::INT)::VARCHAR END"


def _crs_sql(c: str) -> str:
    return "'CRS-' || " + " || '-' || ".join(f"({_seg(f'string_split({c}, $$-$$)[{k}]')})" for k in (1, 2, 3))


def _crs_list(x: str) -> str:
    return f"list_sort(list_distinct(list_transform(regexp_extract_all({x}, '{_CRS_SQL}'), lambda c: {_crs_sql('c')})))"


_X = f"x AS (SELECT p_partkey, p_brand, p_size, {CITED} AS x FROM part)"


@query(f"WITH {_X} SELECT p_partkey, array_to_string({_crs_list('x')}, '|') AS ids FROM x")
def crs_canonical(t: Tables) -> DataFrame:
    return _cited(t).select("p_partkey", F.array_join(legal.crs_ids("x"), "|").alias("ids"))


@query(f"""
WITH {_X} SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(x, '{_CCR_SQL}'), lambda c: replace(c, ' ', '_')), '|') AS rules,
  array_to_string(list_transform(regexp_extract_all(x, '{legal.FEDERAL}'), lambda c: regexp_replace(c, '\\s+', ' ', 'g')), '|') AS federal FROM x""")
def reference_ids(t: Tables) -> DataFrame:
    return _cited(t).select("p_partkey", F.array_join(legal.ccr_ids("x"), "|").alias("rules"), F.array_join(legal.federal_ids("x"), "|").alias("federal"))


_URL = """CASE p_partkey % 5 WHEN 0 THEN concat('https://x.org/view?ruleId=', p_size) WHEN 1 THEN concat('https://x.org/view?ruleVersionId=', p_partkey)
 WHEN 2 THEN concat('https://x.org/file/', p_partkey) WHEN 3 THEN NULL ELSE concat('https://x.org/', p_size, ' CCR ') END"""


@query(f"""
WITH u AS (SELECT p_partkey, {_URL} AS url, CASE WHEN p_partkey % 5 = 4 THEN concat(p_size % 12 + 1, ' CCR ', 100 + p_size, '-', p_size) END AS cite FROM part)
SELECT p_partkey, coalesce(replace(nullif(regexp_extract(cite, '{_CCR_SQL}', 0), ''), ' ', '_'), 'CCR_RULE_' || nullif(regexp_extract(url, '[?&]ruleId=([^&#]+)', 1), ''),
  'CCR_VERSION_' || nullif(regexp_extract(url, '[?&]ruleVersionId=([^&#]+)', 1), ''), 'CCR_URL_' || substring(sha256(url), 1, 16), 'CCR_UNKNOWN') AS id FROM u""")
def ccr_canonical(t: Tables) -> DataFrame:
    """The citation, else the rule or version named by the address, else a digest of the address."""
    cite = F.expr("CASE WHEN p_partkey % 5 = 4 THEN concat(p_size % 12 + 1, ' CCR ', 100 + p_size, '-', p_size) END")
    u = t.part.select("p_partkey", F.expr(_URL).alias("url"), cite.alias("cite"))
    named = lambda prefix, key: F.concat(F.lit(prefix), F.nullif(F.regexp_extract("url", rf"[?&]{key}=([^&#]+)", 1), F.lit("")))
    digest = F.concat(F.lit("CCR_URL_"), F.substring(F.sha2("url", 256), 1, 16))
    return u.select("p_partkey", F.coalesce(legal.ccr_ids("cite")[0], named("CCR_RULE_", "ruleId"), named("CCR_VERSION_", "ruleVersionId"), digest, F.lit("CCR_UNKNOWN")).alias("id"))


@query(f"""
WITH {_X}, l AS (SELECT p_partkey, list_concat(regexp_extract_all(x, '{_CCR_SQL}'), regexp_extract_all(x, '{_CRS_SQL}')) AS l FROM x)
SELECT p_partkey, array_to_string(list_filter(l, lambda c, i: list_position(l, c) = i), '|') AS ids FROM l""")
def query_identifiers(t: Tables) -> DataFrame:
    """Identifiers of a request, rules before statutes, distinct in order."""
    found = F.concat(*(F.regexp_extract_all("x", F.lit(p), F.lit(0)) for p in (legal.CCR, legal.CRS)))
    return _cited(t).select("p_partkey", F.array_join(F.array_distinct(found), "|").alias("ids"))


@query(f"""WITH {_X} SELECT p_partkey, array_to_string(list_sort(list_distinct(regexp_extract_all(x, '{legal.TERM}', 1))), '|') AS terms FROM x""")
def defined_terms(t: Tables) -> DataFrame:
    return _cited(t).select("p_partkey", F.array_join(legal.defined_terms("x"), "|").alias("terms"))


@query(f"""
WITH {_X}, c AS (SELECT p_partkey, unnest({_crs_list('x')}) AS id FROM x)
SELECT p_partkey, id FROM c WHERE TRY_CAST(regexp_extract(id, '^CRS-([0-9]+)(?:[.][0-9]+)?-', 1) AS INT) BETWEEN 1 AND {legal.LAST_TITLE}""")
def plausible_ids(t: Tables) -> DataFrame:
    """Statute ids whose title exists."""
    ids = _cited(t).select("p_partkey", F.explode(legal.crs_ids("x")).alias("id"))
    return ids.where(F.regexp_extract("id", r"^CRS-([0-9]+)(?:[.][0-9]+)?-", 1).try_cast("int").between(1, legal.LAST_TITLE))


@query(f"""
WITH {_X}, c AS (SELECT p_partkey, x, unnest(regexp_extract_all(x, '{_CRS_SQL}')) AS c FROM x), q AS (SELECT *, regexp_replace(c, '[.]', '[.]', 'g') AS r FROM c)
SELECT p_partkey, c AS citation, regexp_matches(x, 'C[.]R[.]S[.].{{0,80}}' || r || '|' || r || '.{{0,80}}C[.]R[.]S[.]|§ ?' || r) AS near FROM q""")
def evidence_proximity(t: Tables) -> DataFrame:
    rows = _cited(t).select("p_partkey", "x", F.explode(F.regexp_extract_all("x", F.lit(legal.CRS), F.lit(0))).alias("citation"))
    return rows.select("p_partkey", "citation", legal.near_citation("x", "citation").alias("near"))


@query(f"""
WITH {_X}, l AS (SELECT p_brand, p_size, p_partkey, {_crs_list('x')} AS ids FROM x), j AS (SELECT l.*, lag(ids) OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) AS prior FROM l)
SELECT p_partkey, array_to_string(list_filter(ids, lambda c: list_contains(prior, c)), '|') AS shared FROM j WHERE prior IS NOT NULL""")
def citation_overlap(t: Tables) -> DataFrame:
    """Canonical citations that a part shares with the one before it of its brand and size, in its own order."""
    from pyspark.sql import Window

    ids = _cited(t, "p_brand", "p_size").withColumn("ids", legal.crs_ids("x"))
    prior = ids.withColumn("prior", F.lag("ids").over(Window.partitionBy("p_brand", "p_size").orderBy("p_partkey")))
    return prior.where("prior IS NOT NULL").select("p_partkey", F.array_join(F.array_intersect("ids", "prior"), "|").alias("shared"))


@query("""
WITH c AS (SELECT p_partkey, p_brand, p_size || '-' || p_partkey % 40 || '-' || 100 + p_partkey % 7 AS citation FROM part)
SELECT p_partkey, citation, row_number() OVER (PARTITION BY p_brand ORDER BY string_split(citation, '-')[1]::INT, string_split(citation, '-')[2]::INT, string_split(citation, '-')[3]::INT, p_partkey) AS place FROM c""")
def natural_order(t: Tables) -> DataFrame:
    """Citations of each brand by their numbers, not their spelling."""
    c = t.part.select("p_partkey", "p_brand", F.expr("concat(p_size, '-', p_partkey % 40, '-', 100 + p_partkey % 7)").alias("citation"))
    numbers = [F.split("citation", "-")[k].cast("int") for k in range(3)]
    return ranking.numbered(c, "p_brand", *numbers, F.col("p_partkey")).select("p_partkey", "citation", F.col("rank").alias("place"))


_PAGED = """concat('[[page 1]] C.R.S. ', p_size, '-1-1 opens. [[page 2]] nothing of ', p_type, ' [[page 3]] see C.R.S. section ', p_size, '-1-1 again [[page 4]] C.R.S. is far away from what is cited here, ', p_size, '-1-1')"""


@query(f"""
WITH s AS (SELECT p_partkey, p_size || '-1-1' AS c, string_split_regex({_PAGED}, '\\[\\[page \\d+\\]\\]') AS s FROM part), p AS (SELECT p_partkey, c, s[i] AS page, i - 1 AS n FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM s))
SELECT p_partkey, string_agg(n::VARCHAR, ',' ORDER BY n) AS pages FROM p WHERE n > 0 AND regexp_matches(page, 'C[.]R[.]S[.].{{0,20}}' || c) GROUP BY p_partkey""")
def citation_pages(t: Tables) -> DataFrame:
    """Pages on which the statute is cited by name."""
    texts = t.part.select(F.struct("p_partkey", F.expr("concat(p_size, '-1-1')").alias("c")).alias("k"), F.regexp_replace(F.expr(_PAGED), r"(\[\[page \d+\]\])", "\n$1\n").alias("x"))
    pages = outline.outline(texts, "k", "x", outline.Shape((("page", r"^\[\[page (\d+)"),))).select("k.*", F.col("heading").cast("int").alias("n"), F.col("body").alias("page"))
    hits = pages.where("n > 0").where(F.expr("page rlike concat('C[.]R[.]S[.].{0,20}', c)"))
    return hits.groupBy("p_partkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("n")), lambda n: n.cast("string")), ",").alias("pages"))


@query(f"""
WITH {_X}, s AS (SELECT p_partkey, x, concat(x, ' and 9-9-', p_partkey % 3) AS summary, p_partkey % 11 = 0 AS blank FROM x)
SELECT p_partkey, blank OR length(trim(x)) = 0 AS empty, array_to_string(list_filter({_crs_list('summary')}, lambda c: NOT list_contains({_crs_list('x')}, c)), '|') AS unsupported FROM s""")
def text_integrity(t: Tables) -> DataFrame:
    """Citations of a summary that its text does not have."""
    s = _cited(t).select("p_partkey", "x", F.expr("concat(x, ' and 9-9-', p_partkey % 3)").alias("summary"))
    extra = F.array_except(legal.crs_ids("summary"), legal.crs_ids("x"))
    empty = (F.col("p_partkey") % 11 == 0) | ~text.populated("x")
    return s.select("p_partkey", empty.alias("empty"), F.array_join(extra, "|").alias("unsupported"))


@query(f"""
WITH {_X}, s AS (SELECT p_partkey, x FROM x), n AS (SELECT p_partkey, lower(regexp_replace(x, '[^A-Za-z0-9]+', '', 'g')) AS compact, x, substring(x, 1, 40) AS a, upper(substring(x, 5, 30)) AS b, 'never said' AS c FROM s)
SELECT p_partkey, q AS claim, CASE WHEN contains(x, q) THEN 1.0 WHEN contains(compact, lower(regexp_replace(q, '[^A-Za-z0-9]+', '', 'g'))) THEN 0.9 ELSE 0.2 END::DOUBLE AS fidelity
FROM (SELECT p_partkey, x, compact, unnest([a, b, c]) AS q FROM n)""")
def source_fidelity(t: Tables) -> DataFrame:
    """Is a claim in its source word for word (1), but for signs and case (.9), or not (.2)?"""
    claims = F.explode(F.array(F.substring("x", 1, 40), F.upper(F.substring("x", 5, 30)), F.lit("never said"))).alias("claim")
    compact = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", ""))
    rows = _cited(t).select("p_partkey", "x", claims)
    level = text.ladder((F.col("x").contains(F.col("claim")), 1.0), (compact("x").contains(compact("claim")), 0.9), otherwise=0.2)
    return rows.select("p_partkey", "claim", level.cast("double").alias("fidelity"))


@query("""
SELECT p_partkey, upper(regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug, sha256(concat_ws('::', p_brand, p_type, p_partkey)) AS uid FROM part""")
def stable_names(t: Tables) -> DataFrame:
    """Safe stems, and identifiers that depend on the parts of a key alone."""
    return t.part.select("p_partkey", legal.slug("p_name").alias("slug"), F.sha2(F.concat_ws("::", "p_brand", "p_type", F.col("p_partkey").cast("string")), 256).alias("uid"))
