"""Queries of search that is served by an index, each beside the SQL of a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry.operators import search, search_index
from lexquarry.plans.registry import Tables, query
from lexquarry.plans.search_queries import RULES
from lexquarry.scratch import new_path
from lexquarry.sources.published import Version

_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"
_built: dict[tuple[str, str], tuple[str, Version]] = {}
_updated: dict[tuple[str, str], Version] = {}


def _index(t: Tables) -> tuple[str, Version]:
    """Folder and first version of the index of all documents, built once for a session and folder."""
    own = (t.spark.sparkContext.applicationId, t.folder)
    if own not in _built:
        folder = new_path(t.spark, "index")
        _built[own] = folder, search_index.build_index(t.documents, folder, "doc_id", "text", ["lang", "source"])
    return _built[own]


def _sql(request: search.Request, docs: str = "documents") -> str:
    """The SQL of a request's scored documents by reading all texts."""
    has = lambda w: f"contains(' ' || norm || ' ', ' {w} ')"
    count = lambda w: f"least((length(norm) - length(replace(norm, '{w}', ''))) // {len(w)}, 12)"
    hits = " + ".join(f"{has(w)}::INT" for w in request.terms)
    part = " + ".join(f"CASE WHEN {has(w)} THEN 24 + {count(w)} ELSE 0 END" for w in request.terms)
    part += "".join(f" + CASE WHEN {has(w)} THEN {p} ELSE 0 END" for d, w, p in RULES.boosts if d in request.domains)
    part += "".join(f" + CASE WHEN lang = '{k}' THEN {p} ELSE 0 END" for k, p in request.preferred)
    anchors = " OR ".join(has(a) for a in request.anchors) or "true"
    return f"""n AS (SELECT doc_id, lang, source, {_NORM} AS norm FROM {docs}), h AS (SELECT doc_id AS key, lang, source, ({hits})::BIGINT AS hits, (40 + {part})::BIGINT AS score FROM n WHERE {anchors}),
 f AS (SELECT * FROM h WHERE hits >= {request.least} AND score > 0)"""


_LICENSE = search.understand("Which license holds for this version?", RULES)
_SECRET = search.understand("a secret token or password", RULES)
_GERMAN = search.understand("license of german texts", RULES)
_INSULT = search.understand("insult", RULES)


def _found(t: Tables, request: search.Request, k: int) -> DataFrame:
    return search_index.search(_index(t)[1], request, RULES, k, kind="lang")


@query(f"WITH {_sql(_LICENSE)} SELECT * FROM f ORDER BY score DESC, key LIMIT 20")
def index_license(t: Tables) -> DataFrame:
    return _found(t, _LICENSE, 20)


@query(f"WITH {_sql(_SECRET)} SELECT * FROM f ORDER BY score DESC, key LIMIT 100")
def index_secret(t: Tables) -> DataFrame:
    return _found(t, _SECRET, 100)


@query(f"WITH {_sql(_GERMAN)} SELECT * FROM f ORDER BY score DESC, key LIMIT 10")
def index_preferred(t: Tables) -> DataFrame:
    """Texts of the preferred kind go first."""
    return _found(t, _GERMAN, 10)


@query(f"WITH {_sql(_INSULT)} SELECT * FROM f ORDER BY score DESC, key LIMIT 5")
def index_insult(t: Tables) -> DataFrame:
    return _found(t, _INSULT, 5)


@query(f"""
WITH w AS (SELECT doc_id, norm, unnest(list_distinct(string_split(norm, ' '))) AS token FROM (SELECT doc_id, {_NORM} AS norm FROM documents))
SELECT token, count(*)::BIGINT AS n, max(least((length(norm) - length(replace(norm, token, ''))) // length(token), 12))::BIGINT AS most FROM w WHERE token IN ({", ".join(f"'{w}'" for w in _SECRET.terms)}) GROUP BY token""")
def index_tokens(t: Tables) -> DataFrame:
    """In how many texts a term stands, and how often at most, from the index's maxima alone."""
    version = _index(t)[1]
    return version.table("postings-0").where(F.col("token").isin(*_SECRET.terms)).groupBy("token").agg(F.sum("n").alias("n"), F.max("most").cast("long").alias("most"))


_CHANGED = """(SELECT d.doc_id, lang, source, CASE WHEN l.quality = 0 THEN text || ' Apache license, version 2' ELSE text END AS text FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(l.toxic, 0) = 0)"""


@query(f"WITH {_sql(_LICENSE, _CHANGED)} SELECT * FROM f ORDER BY score DESC, key LIMIT 50")
def index_updated(t: Tables) -> DataFrame:
    """After an update: texts of low quality got a licence line, and toxic ones were removed."""
    folder, _ = _index(t)
    own = (t.spark.sparkContext.applicationId, t.folder)
    if own not in _updated:
        judged = t.documents.join(t.labels, "doc_id")
        changed = judged.where("quality = 0 AND toxic = 0").withColumn("text", F.concat("text", F.lit(" Apache license, version 2")))
        removed = judged.where("toxic = 1").select("doc_id")
        _updated[own] = search_index.update_index(changed, folder, "doc_id", "text", removed=removed)
    return search_index.search(_updated[own], _LICENSE, RULES, 50, kind="lang")
