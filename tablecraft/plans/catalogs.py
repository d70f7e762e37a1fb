"""Catalog classification, glossary matching and lineage walks.

The catalog describes tables this library builds from the given ones; keys that
are not declared are measured on their rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.operators import catalog_rules as rules
from tablecraft.operators import determinism as det
from tablecraft.operators import glossary as gl
from tablecraft.operators import lineage as ln
from tablecraft.operators.joins import enrich_mappings
from tablecraft.plans import fixtures as fx
from tablecraft.plans.basics import KEY_EDGES_SQL, NODES_SQL, key_edges, key_nodes
from tablecraft.plans.history import customer_history
from tablecraft.plans.registry import query
from tablecraft.plans.stars import FACT_SQL, fact_members, fact_sales, sales_core, sales_join
from tablecraft.plans.vaults import hub_customer, link_rows, sat_customer
from tablecraft.session import cut_lineage, work_path
from tablecraft.sources import profiles
from tablecraft.sources.tables import catalog, read_table, rows

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# ------------------------------------------------------------ measured catalog


def _profile_sql(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (col, kind) in enumerate(columns, start=1):
        parts.append(
            f"""SELECT '{table}' AS table_name, '{col}' AS column_name, '{kind}' AS data_type,
                CAST({i} AS INTEGER) AS ordinal, count(*) AS row_count,
                count(*) - count({col}) AS null_count, count(DISTINCT {col}) AS distinct_count,
                count({col}) = count(*) AND count(DISTINCT {col}) = count(*) AND count(*) > 0
                  AS is_unique FROM {table}"""
        )
    return " UNION ALL ".join(parts)


# The columns of the given tables, as Spark names their types.
GIVEN_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ", 1)) for c in spec.split(",")]


@query(
    "catalog_columns",
    " UNION ALL ".join(_profile_sql(t, _columns(GIVEN_COLUMNS[t])) for t in TABLES),
)
def catalog_columns(spark, d):
    tables = {t: read_table(spark, d, t) for t in TABLES}
    return catalog(spark, tables).drop("is_primary_key", "nullable")


SKETCHED_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type,
        CAST({i} AS INTEGER) AS ordinal, count(*) AS row_count, count(*) - count({c}) AS null_count,
        count({c}) = count(*) AND count(DISTINCT {c}) = count(*) AND count(*) > 0 AS is_unique
        FROM {t}"""
    for t in TABLES
    for i, (c, kind) in enumerate(_columns(GIVEN_COLUMNS[t]), start=1)
)


@query("catalog_sketched", SKETCHED_SQL)
def catalog_sketched(spark, d):
    """The same catalog from stored sketches: one pass per file, exact counts for possible keys."""
    paths = {t: f"{d}/{t}.parquet" for t in TABLES}
    store = work_path(spark, "profiles")
    profiles.update(spark, paths, store)
    found = profiles.with_keys(spark, paths, profiles.summary(spark, paths, store))
    return found.select(
        "table_name", "column_name", "data_type", "ordinal", "row_count", "null_count", "is_unique"
    )


# ---------------------------------------------------- catalog of built tables


def built_tables(spark, d, members=None):
    return {
        "hub_customer": hub_customer(spark, d),
        "link_order_customer": link_rows(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])),
        "sat_customer": sat_customer(spark, d),
        "dim_customer": customer_history(spark, d).withColumnRenamed("sk", "customer_sk"),
        "fact_sales": fact_sales(spark, d, members),
        "customer": read_table(spark, d, "customer"),
        "orders": read_table(spark, d, "orders"),
        "events": read_table(spark, d, "events"),
    }


DECLARED_KEYS = {
    "hub_customer": ["hk_customer"],
    "link_order_customer": ["hk_order_customer"],
    "sat_customer": ["load_date"],
}
MEASURED = ["dim_customer", "fact_sales", "customer", "orders", "events"]
BUILT_COLUMNS = {
    "hub_customer": "hk_customer string, customer_bk string, load_date timestamp_ntz, "
    "record_source string",
    "link_order_customer": "hk_order_customer string, hk_order string, hk_customer string, "
    "load_date timestamp_ntz, record_source string",
    "sat_customer": "hk_customer string, load_date timestamp_ntz, c_mktsegment string, "
    "last_priority string, last_status string, hash_diff string, record_source string",
    "dim_customer": "c_custkey bigint, c_name string, c_mktsegment string, last_priority string, "
    "last_status string, valid_from timestamp_ntz, customer_sk string, valid_to timestamp_ntz, "
    "is_current boolean",
    "fact_sales": "customer_sk bigint, part_sk bigint, supplier_sk bigint, date_key bigint, "
    "quantity double, sales_amount double, discount_rate double",
    "customer": GIVEN_COLUMNS["customer"],
    "orders": GIVEN_COLUMNS["orders"],
    "events": GIVEN_COLUMNS["events"],
}


def _static_rows() -> str:
    out = []
    for table, spec in BUILT_COLUMNS.items():
        for i, (col, kind) in enumerate(_columns(spec), start=1):
            declared = str(col in DECLARED_KEYS.get(table, ())).lower()
            out.append(f"('{table}', '{col}', '{kind}', {i}, {declared})")
    return ", ".join(out)


def _unique_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS t, '{c}' AS c, count(DISTINCT {c}) = count(*) AS u FROM {t}_rows"
        for t in MEASURED
        for c, _ in _columns(BUILT_COLUMNS[t])
    )


CATALOG_SQL = f"""
  {fx.HISTORY_SQL.strip()}, {fx.FACT_ROWS_SQL}, {FACT_SQL},
  dim_customer_rows AS (
    SELECT * EXCLUDE (c_custkey), c_custkey, sha256(CAST(c_custkey AS VARCHAR) || '||' ||
           {fx.stamp_sql('valid_from')}) AS customer_sk FROM history),
  fact_sales_rows AS (SELECT * FROM fact_sales),
  customer_rows AS (SELECT * FROM customer), orders_rows AS (SELECT * FROM orders),
  events_rows AS (SELECT * FROM events),
  stat AS (SELECT * FROM (VALUES {_static_rows()})
           v(table_name, column_name, data_type, ordinal, declared)),
  uniq AS ({_unique_rows()}),
  first_unique AS (
    SELECT s.table_name, min(ordinal) AS o FROM stat s
    JOIN uniq ON s.table_name = uniq.t AND s.column_name = uniq.c AND uniq.u GROUP BY 1),
  cat AS (
    SELECT s.table_name, column_name, data_type, ordinal,
           declared OR coalesce(ordinal = f.o, false) AS is_primary_key
    FROM stat s LEFT JOIN first_unique f ON s.table_name = f.table_name)"""


def built_catalog(spark, d):
    members = fact_members(spark, d)
    tables = built_tables(spark, d, members)
    tables["dim_customer"] = cut_lineage(tables["dim_customer"], "dim_customer")  # has a key, so it is read again
    # every member, and the unknown one
    core = sales_core(spark, d), {sk: dim.count() + 1 for sk, dim in members.items()}
    found = catalog(
        spark, tables, DECLARED_KEYS, measured=MEASURED, counts=False, derived=["fact_sales"],
        cores={"fact_sales": core}, joins={"fact_sales": sales_join(spark, d)},
    )
    return found.select("table_name", "column_name", "data_type", "ordinal", "is_primary_key")


def case_sql(col: str, table: list, anchored: bool = False, default: str = "NULL") -> str:
    """First label whose pattern hits, as a SQL CASE."""
    whens = []
    for label, patterns in table:
        for p in patterns:
            text = f"^(?:{p})" if anchored else p
            whens.append(f"WHEN regexp_matches({col}, '{text}') THEN '{label}'")
    return f"CASE {' '.join(whens)} ELSE {default} END"


def any_sql(col: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({col}, '{p}')" for p in patterns) + ")"


def names_sql(flag: str) -> str:
    """Flagged column names of a table in order, joined by commas."""
    return f"coalesce(string_agg(lower(column_name), ',' ORDER BY ordinal) FILTER ({flag}), '')"


def _joined(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.array_join(c, ","))
    return df


@query(
    "catalog_stats",
    f"""WITH {CATALOG_SQL}
        SELECT table_name, count(*) AS columns, count(*) FILTER (is_primary_key) AS key_columns,
               count(*) FILTER (data_type IN ('int', 'bigint', 'double')) AS numeric_columns
        FROM cat GROUP BY 1""",
)
def catalog_stats(spark, d):
    return rules.catalog_stats(built_catalog(spark, d))


@query(
    "catalog_layers",
    f"""WITH {CATALOG_SQL}, l AS (
          SELECT *, CASE WHEN regexp_matches(table_name, '^stg_') THEN 'staging'
                   WHEN regexp_matches(table_name, '^(hub|link|sat|int)_') THEN 'integration'
                   WHEN regexp_matches(table_name, '^(dim|fact|fct)_') THEN 'business'
                   ELSE 'source' END AS layer FROM cat)
        SELECT layer, count(DISTINCT table_name) AS tables, count(*) AS columns,
               count(*) FILTER (is_primary_key) AS key_columns,
               CAST(CASE layer WHEN 'source' THEN 0 WHEN 'staging' THEN 1 WHEN 'integration' THEN 2
                    ELSE 3 END AS BIGINT) AS sort_rank FROM l GROUP BY 1 ORDER BY sort_rank""",
)
def catalog_layers(spark, d):
    return rules.layer_stats(built_catalog(spark, d))


TIE_SQL = " ".join(
    f"WHEN regexp_matches(lower(column_name), '^(?:{p})') THEN {i}"
    for i, p in enumerate(det.TIE_BREAKER_PATTERNS, start=1)
)


@query(
    "suggest_tie_breakers",
    f"""WITH {CATALOG_SQL} SELECT * FROM (
          SELECT table_name, column_name, is_primary_key,
                 CAST(CASE {TIE_SQL} END AS BIGINT) AS priority FROM cat)
        WHERE priority IS NOT NULL""",
)
def suggest_tie_breakers(spark, d):
    return det.suggest_tie_breakers(built_catalog(spark, d)).select(
        "table_name", "column_name", "is_primary_key", "priority"
    )


ROLE_SQL = case_sql("lower(column_name)", rules.TEMPORAL_PATTERNS, anchored=True)
SURE = [
    (label, [p for p in patterns if p.startswith("^") and p.endswith("$")])
    for label, patterns in rules.TEMPORAL_PATTERNS
]
# surrogate names hit the open patterns first, so they are never sure
IS_SURE = case_sql("lower(column_name)", [("sure", [p for label, ps in SURE for p in ps
                                                    if label != "surrogate_key"])], anchored=True)


@query(
    "catalog_temporal",
    f"""WITH {CATALOG_SQL}, r AS (SELECT *, {ROLE_SQL} AS role, {IS_SURE} IS NOT NULL AS sure
          FROM cat)
        SELECT table_name, column_name, role, is_primary_key, CAST(round(
                 CASE WHEN sure THEN 0.9 ELSE 0.7 END + CASE WHEN role IN ('valid_from', 'valid_to',
                   'business_date', 'system_date') AND regexp_matches(data_type, 'date|time')
                   THEN 0.1 ELSE 0.0 END, 2) AS DOUBLE) AS confidence
        FROM r WHERE role IS NOT NULL""",
)
def catalog_temporal(spark, d):
    return rules.tag_temporal(built_catalog(spark, d)).select(
        "table_name", "column_name", "role", "is_primary_key", "confidence"
    )


@query(
    "catalog_scd_type",
    f"""WITH {CATALOG_SQL}, r AS (SELECT *, {ROLE_SQL} AS role FROM cat),
        t AS (
          SELECT table_name, bool_or(coalesce(role = 'valid_from', false)) AS f,
                 bool_or(coalesce(role = 'valid_to', false)) AS t,
                 bool_or(coalesce(role = 'is_current', false)) AS c,
                 bool_or(coalesce(role = 'business_date', false)) AS b,
                 bool_or(coalesce(role = 'system_date', false)) AS s,
                 arg_min(column_name, ordinal) FILTER (role = 'surrogate_key') AS surrogate_key
          FROM r GROUP BY 1)
        SELECT t.table_name, CASE WHEN f OR c THEN 'TYPE_2' ELSE 'TYPE_1' END AS scd_type,
               CAST(CASE WHEN f AND t AND b AND s THEN 0.95 WHEN f AND t THEN 0.9 WHEN f THEN 0.7
                         WHEN c THEN 0.6 ELSE 0.8 END AS DOUBLE) AS confidence,
               f AND t AND b AND s AS is_bi_temporal, surrogate_key,
               coalesce(string_agg(column_name, ',' ORDER BY ordinal) FILTER (is_primary_key
                 AND column_name IS DISTINCT FROM surrogate_key), '') AS natural_keys,
               coalesce(string_agg(column_name, ',' ORDER BY ordinal) FILTER (role IS NULL
                 AND NOT is_primary_key), '') AS tracking_columns
        FROM t JOIN r ON t.table_name = r.table_name GROUP BY ALL""",
)
def catalog_scd_type(spark, d):
    found = rules.classify_scd(built_catalog(spark, d)).drop("findings")
    return _joined(found, "natural_keys", "tracking_columns")


def missing_sql(kind: str, source: str, has: dict[str, str]) -> str:
    """What the constructs of ``source`` need by the rule table and lack."""
    return " UNION ALL ".join(
        f"SELECT table_name, '{level}' AS level, 'missing' AS code, '{part}' AS subject FROM {source} "
        f"WHERE {kind} = '{construct}' AND NOT ({has[part]})"
        for construct, parts in rules.NEEDS.items()
        for part, level in parts.items()
        if part in has
    )


@query(
    "catalog_scd_findings",
    f"""WITH {CATALOG_SQL}, r AS (SELECT *, {ROLE_SQL} AS role FROM cat),
        t AS (
          SELECT table_name, count(*) FILTER (role = 'valid_from') AS f,
                 count(*) FILTER (role = 'valid_to') AS t, count(*) FILTER (role = 'is_current') AS c,
                 count(*) FILTER (role = 'system_date') AS s,
                 count(*) FILTER (is_primary_key OR role = 'surrogate_key'
                   OR regexp_matches(lower(column_name), '(_sk|^sk)$')) AS k
          FROM r GROUP BY 1),
        kinds AS (SELECT *, CASE WHEN f + c > 0 THEN 'TYPE_2' ELSE 'TYPE_1' END AS kind FROM t)
        {missing_sql('kind', 'kinds', {'row_key': 'k > 0', 'valid_from': 'f > 0', 'valid_to': 't > 0',
                                       'is_current': 'c > 0', 'system_date': 's > 0'})}""",
)
def catalog_scd_findings(spark, d):
    """What the tables lack to keep a history."""
    return rules.findings(rules.classify_scd(built_catalog(spark, d)))


@query(
    "catalog_scd_columns",
    f"""WITH {CATALOG_SQL}
        SELECT table_name, column_name, is_primary_key, CASE WHEN {ROLE_SQL} IS NOT NULL
                 THEN 'temporal'
                 WHEN regexp_matches(column_name, '(_sk|^sk|^surrogate_key)$') THEN 'surrogate_key'
                 WHEN regexp_matches(column_name, '(_id|^id)$') THEN 'natural_key'
                 WHEN regexp_matches(column_name, 'created|updated|modified|load|insert')
                   THEN 'audit'
                 WHEN regexp_matches(column_name, 'status|flag|code|type') THEN 'type1'
                 ELSE 'type2' END AS column_class FROM cat""",
)
def catalog_scd_columns(spark, d):
    return rules.classify_columns(built_catalog(spark, d)).select(
        "table_name", "column_name", "is_primary_key", "column_class"
    )


VAULT_ROLE_SQL = (
    "CASE WHEN " + any_sql("lower(column_name)", rules.VAULT_ROLES[4][1])
    + f" THEN 'hash_diff' ELSE {case_sql('lower(column_name)', rules.VAULT_ROLES, default=chr(39) + 'attribute' + chr(39))} END"
)
VAULT_KIND_SQL = case_sql("lower(table_name)", rules.VAULT_TABLES)
VAULT_SQL = f"""
  {CATALOG_SQL.strip()}, vr AS (SELECT *, {VAULT_ROLE_SQL} AS role FROM cat),
  vt AS (
    SELECT table_name, {VAULT_KIND_SQL} AS named,
           arg_min(column_name, ordinal) FILTER (role = 'hash_key') AS hash_key,
           {names_sql("role = 'business_key'")} AS business_keys,
           arg_max(column_name, ordinal) FILTER (role = 'load_date') AS ld,
           arg_max(column_name, ordinal) FILTER (role = 'record_source') AS rs,
           arg_max(column_name, ordinal) FILTER (role = 'hash_diff') AS hd
    FROM vr GROUP BY 1),
  vl AS (
    SELECT vt.*, coalesce(string_agg(substring(column_name, 4), ',' ORDER BY ordinal) FILTER (
             regexp_matches(column_name, '^hk_[a-z0-9_]+$') AND NOT is_primary_key
             AND column_name IS DISTINCT FROM hash_key), '') AS linked_hubs
    FROM vt JOIN vr ON vt.table_name = vr.table_name GROUP BY ALL),
  vk AS (
    SELECT *, CASE WHEN linked_hubs = '' THEN 0
                   ELSE length(linked_hubs) - length(replace(linked_hubs, ',', '')) + 1 END AS nh
    FROM vl),
  constructs AS (
    SELECT *, coalesce(named, CASE WHEN hash_key IS NOT NULL AND business_keys <> '' AND nh = 0
             THEN 'hub' WHEN nh >= 2 THEN 'link' WHEN hd IS NOT NULL AND ld IS NOT NULL
             THEN 'satellite' END, 'unknown') AS construct_type FROM vk)"""


@query(
    "catalog_vault",
    f"""WITH {VAULT_SQL}
        SELECT table_name, construct_type, hash_key, business_keys, ld AS load_date_column,
               rs AS record_source_column, linked_hubs,
               CAST(round(least(1.0, CASE WHEN named IS NOT NULL THEN 0.8
                 WHEN construct_type <> 'unknown' THEN 0.5 ELSE 0.0 END + CASE named
                 WHEN 'hub' THEN 0.3 * (hash_key IS NOT NULL)::INT + 0.3 * (business_keys <> '')::INT
                   + 0.2 * (ld IS NOT NULL)::INT + 0.2 * (rs IS NOT NULL)::INT
                 WHEN 'link' THEN 0.25 * (hash_key IS NOT NULL)::INT
                   + CASE WHEN nh >= 2 THEN 0.35 WHEN nh = 1 THEN 0.15 ELSE 0 END
                   + 0.2 * (ld IS NOT NULL)::INT + 0.2 * (rs IS NOT NULL)::INT
                 WHEN 'satellite' THEN 0.25 * ((hash_key IS NOT NULL)::INT + (ld IS NOT NULL)::INT
                   + (hd IS NOT NULL)::INT + (rs IS NOT NULL)::INT)
                 ELSE 0.0 END), 2) AS DOUBLE) AS confidence,
               CASE WHEN construct_type = 'satellite' THEN CASE WHEN nh > 0
                 THEN split_part(linked_hubs, ',', 1) WHEN hash_key LIKE 'hk!_%' ESCAPE '!'
                 THEN substring(hash_key, 4) END END AS parent_hub
        FROM constructs""",
)
def catalog_vault(spark, d):
    found = rules.classify_vault(built_catalog(spark, d)).drop("findings", "suggested_name")
    return _joined(found, "business_keys", "linked_hubs")


VAULT_HAS = {
    "hash_key": "hash_key IS NOT NULL", "business_key": "business_keys <> ''", "load_date": "ld IS NOT NULL",
    "record_source": "rs IS NOT NULL", "hash_diff": "hd IS NOT NULL", "second_hub": "nh >= 2",
    "attribute": "EXISTS (SELECT 1 FROM vr WHERE vr.table_name = constructs.table_name AND role = 'attribute')",
}


@query(
    "catalog_vault_findings",
    f"""WITH {VAULT_SQL}, hubs AS (SELECT lower(table_name) AS h FROM constructs
                                   WHERE construct_type = 'hub'),
        refs AS (SELECT table_name, unnest(string_split(linked_hubs, ',')) AS r FROM constructs
                 WHERE construct_type = 'link' AND linked_hubs <> ''),
        sats AS (SELECT table_name, substring(hash_key, 4) AS p FROM constructs
                 WHERE construct_type = 'satellite')
        SELECT table_name, 'issue' AS level, 'unknown' AS code, r AS subject FROM refs
        WHERE NOT EXISTS (SELECT 1 FROM hubs WHERE contains(h, r))
        UNION ALL
        SELECT h, 'warning', 'missing', 'satellite' FROM hubs
        WHERE NOT EXISTS (SELECT 1 FROM sats WHERE contains(h, p))
        UNION ALL {missing_sql('construct_type', 'constructs', VAULT_HAS)}""",
)
def catalog_vault_findings(spark, d):
    return rules.validate_vault(rules.classify_vault(built_catalog(spark, d)))


@query(
    "propose_vault",
    f"""WITH {CATALOG_SQL}, t AS (
          SELECT table_name, {names_sql('is_primary_key')} AS keys,
                 {names_sql('NOT is_primary_key')} AS others FROM cat GROUP BY 1)
        SELECT 'hub' AS construct, 'hub_' || table_name AS name, table_name AS source_entity,
               keys AS columns FROM t WHERE keys <> ''
        UNION ALL SELECT 'satellite', 'sat_' || table_name, table_name, others FROM t
        WHERE keys <> '' AND others <> ''
        UNION ALL SELECT 'link', 'link_part_supplier', 'part', 'hub_part,hub_supplier'
        FROM (SELECT max(a) AS a, max(b) AS b FROM
              (SELECT count(DISTINCT l_suppkey) AS a, 0 AS b FROM lineitem GROUP BY l_partkey
               UNION ALL SELECT 0, count(DISTINCT l_partkey) FROM lineitem GROUP BY l_suppkey))
        WHERE a > 1 AND b > 1""",
)
def propose_vault(spark, d):
    """Keyed tables as hubs; part and supplier are linked if the line items say n:m."""
    from tablecraft.operators.quality import measure_cardinality

    pairs = read_table(spark, d, "lineitem", ["l_partkey", "l_suppkey"]).distinct()
    # seen from the pairs: many pairs per part and many per supplier make it n:m
    relation = measure_cardinality(pairs, pairs, ["l_partkey"], ["l_suppkey"]).select(
        F.lit("part").alias("source"), F.lit("supplier").alias("target"), "cardinality"
    )
    return _joined(rules.propose_vault(built_catalog(spark, d), relation), "columns")


STAR_NUMERIC = "data_type IN ('int', 'bigint', 'double')"
STAR_KIND_SQL = case_sql("lower(table_name)", rules.STAR_TABLES)
STAR_SQL = f"""
  {CATALOG_SQL.strip()}, sc AS (
    SELECT *, {any_sql('lower(column_name)', rules.STAR_SURROGATE)} AS sur,
           {any_sql('lower(column_name)', rules.STAR_MEASURE)} OR {STAR_NUMERIC} AS num FROM cat),
  st AS (
    SELECT table_name, {STAR_KIND_SQL} AS named, count(*) FILTER (sur) AS n_sur,
           arg_max(column_name, ordinal) FILTER (sur AND is_primary_key) AS surrogate_key,
           arg_min(column_name, ordinal) FILTER (is_primary_key AND NOT sur) AS natural_key,
           {names_sql('sur AND NOT is_primary_key')} AS dimension_keys,
           {names_sql('num AND NOT sur')} AS measures,
           {names_sql('NOT sur AND NOT num')} AS attributes,
           count(*) FILTER (sur AND NOT is_primary_key) AS n_fk,
           count(*) FILTER (num AND NOT sur) AS n_m, count(*) FILTER (NOT sur AND NOT num) AS n_a,
           string_agg(replace(replace(column_name, '_sk', ''), '_key', ''), ' x ' ORDER BY ordinal)
             FILTER (sur AND NOT is_primary_key AND fk_no <= 3) AS stems
    FROM (SELECT *, count(*) FILTER (sur AND NOT is_primary_key) OVER (PARTITION BY table_name
            ORDER BY ordinal ROWS UNBOUNDED PRECEDING) AS fk_no FROM sc) GROUP BY 1),
  stars AS (
    SELECT *, coalesce(named, CASE WHEN n_fk >= 2 AND n_m >= 1 THEN 'fact'
             WHEN n_sur = 1 AND n_a > 2 THEN 'dimension' END, 'unknown') AS construct_type FROM st)"""


@query(
    "catalog_dimensional",
    f"""WITH {STAR_SQL}
        SELECT table_name, construct_type, surrogate_key, natural_key, dimension_keys, measures,
               attributes, CASE WHEN construct_type = 'fact' THEN coalesce(stems, '') ELSE '' END
                 AS grain,
               CAST(round(least(1.0, CASE WHEN named IS NOT NULL THEN 0.8 ELSE 0.0 END
                 + CASE construct_type WHEN 'fact' THEN 0.3 * (n_fk > 0)::INT + 0.3 * (n_m > 0)::INT
                     + 0.2 * (surrogate_key IS NOT NULL)::INT
                   WHEN 'dimension' THEN 0.4 * (surrogate_key IS NOT NULL)::INT
                     + 0.3 * (n_a > 0)::INT
                     + 0.3 * (natural_key IS NOT NULL OR n_a > 2)::INT ELSE 0.0 END), 2)
                 AS DOUBLE) AS confidence
        FROM stars""",
)
def catalog_dimensional(spark, d):
    found = rules.classify_dimensional(built_catalog(spark, d)).drop("findings")
    return _joined(found, "dimension_keys", "measures", "attributes")


@query(
    "catalog_star_findings",
    f"""WITH {STAR_SQL}, dims AS (SELECT * FROM stars WHERE construct_type = 'dimension'),
        facts AS (SELECT * FROM stars WHERE construct_type = 'fact'),
        k AS (SELECT table_name, unnest(string_split(dimension_keys, ',')) AS key FROM facts
              WHERE dimension_keys <> '')
        SELECT table_name, 'warning' AS level, 'unknown' AS code, key AS subject FROM k
        WHERE NOT EXISTS (SELECT 1 FROM dims WHERE contains(dims.table_name,
              replace(replace(key, '_sk', ''), '_key', '')))
        UNION ALL {missing_sql('construct_type', 'stars', {
            'dimension_key': 'n_fk > 0', 'measure': 'n_m > 0', 'surrogate_key': 'surrogate_key IS NOT NULL',
            'second_attribute': 'n_a > 1'})}""",
)
def catalog_star_findings(spark, d):
    return rules.validate_star(rules.classify_dimensional(built_catalog(spark, d)))


@query(
    "catalog_measures",
    f"""WITH {STAR_SQL}
        SELECT table_name, lower(column_name) AS column_name, is_primary_key,
               CASE WHEN regexp_matches(column_name, 'ratio|rate|pct|percent|avg')
                    THEN 'non_additive'
                    WHEN regexp_matches(column_name, 'balance|inventory|headcount')
                    THEN 'semi_additive' ELSE 'additive' END AS measure_type,
               CASE WHEN regexp_matches(column_name, '(^|_)(count|cnt)(_|$)') THEN 'COUNT'
                    WHEN regexp_matches(column_name, '(^|_)(avg|average)(_|$)') THEN 'AVG'
                    WHEN regexp_matches(column_name, '(^|_)max(_|$)') THEN 'MAX'
                    WHEN regexp_matches(column_name, '(^|_)min(_|$)') THEN 'MIN'
                    ELSE 'SUM' END AS aggregation
        FROM sc WHERE num AND NOT sur""",
)
def catalog_measures(spark, d):
    return rules.star_columns(built_catalog(spark, d)).filter("is_measure").select(
        "table_name", "column_name", "is_primary_key", "measure_type", "aggregation"
    )


@query(
    "propose_star",
    f"""WITH {CATALOG_SQL}, t AS (
          SELECT table_name, count(*) FILTER ({STAR_NUMERIC}) AS nn,
                 count(*) FILTER (NOT ({STAR_NUMERIC})) AS nt,
                 arg_min(column_name, ordinal) FILTER (is_primary_key) AS pk FROM cat GROUP BY 1),
        dm AS (
          SELECT t.table_name, pk, CASE WHEN starts_with(t.table_name, 'dim_') THEN t.table_name
                   ELSE 'dim_' || t.table_name END AS name,
                 coalesce(string_agg(column_name, ',' ORDER BY ordinal) FILTER (
                   NOT ({STAR_NUMERIC}) AND column_name IS DISTINCT FROM pk), '') AS texts
          FROM t JOIN cat ON t.table_name = cat.table_name WHERE nt > nn AND nt >= 2 GROUP BY ALL)
        SELECT 'dimension' AS element, name, table_name AS source,
               table_name || '_sk' AS surrogate_key, pk AS natural_key, texts AS detail FROM dm
        UNION ALL SELECT 'relationship', name, 'fact_main', table_name || '_sk', NULL, 'many_to_one'
        FROM dm
        UNION ALL SELECT 'measure', column_name, cat.table_name || '.' || column_name, NULL, NULL,
               CASE WHEN regexp_matches(column_name, '(^|_)(count|cnt)(_|$)') THEN 'COUNT'
                    WHEN regexp_matches(column_name, '(^|_)(avg|average)(_|$)') THEN 'AVG'
                    WHEN regexp_matches(column_name, '(^|_)max(_|$)') THEN 'MAX'
                    WHEN regexp_matches(column_name, '(^|_)min(_|$)') THEN 'MIN' ELSE 'SUM' END
        FROM cat JOIN t ON cat.table_name = t.table_name
        WHERE {STAR_NUMERIC} AND NOT (nt > nn AND nt >= 2)""",
)
def propose_star(spark, d):
    return rules.propose_star(built_catalog(spark, d))


# -------------------------------------------------------------------- lineage


# Data flows from region to nation to supplier to part, and from nation to customer.
FEEDS_SQL = f"""
  {KEY_EDGES_SQL.strip()},
  feeds AS (SELECT target AS source, source AS target FROM edges
            UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer)"""


def feeds(spark, d, distinct=True):
    edges = key_edges(spark, d, distinct).select(F.col("target").alias("source"), F.col("source").alias("target"))
    customers = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"]).select(
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("source"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("target"),
    )
    return edges.unionByName(customers)


def _roots(spark, d, table: str, key: str, prefix: str):
    return read_table(spark, d, table, [key]).select(
        F.concat(F.lit(prefix), F.col(key).cast("string")).alias("root")
    )


@query(
    "lineage_upstream",
    f"""WITH RECURSIVE {FEEDS_SQL}, walk AS (
          SELECT 'p' || p_partkey AS root, 'p' || p_partkey AS node, 0 AS depth FROM part
          UNION ALL
          SELECT root, feeds.source, depth + 1 FROM walk JOIN feeds ON feeds.target = walk.node
          WHERE depth < 3)
        SELECT root, node, CAST(depth AS BIGINT) AS depth, count(*) AS n_paths FROM walk
        WHERE depth > 0 GROUP BY 1, 2, 3""",
)
def lineage_upstream(spark, d):
    return ln.upstream(feeds(spark, d), _roots(spark, d, "part", "p_partkey", "p"), 3)


@query(
    "lineage_downstream",
    f"""WITH RECURSIVE {FEEDS_SQL}, walk AS (
          SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS node, 0 AS depth FROM region
          UNION
          SELECT root, feeds.target, depth + 1 FROM walk JOIN feeds ON feeds.source = walk.node
          WHERE depth < 3)
        SELECT DISTINCT root, node, CAST(depth AS BIGINT) AS depth FROM walk WHERE depth > 0""",
)
def lineage_downstream(spark, d):
    return ln.downstream(feeds(spark, d), _roots(spark, d, "region", "r_regionkey", "r"), 3)


@query(
    "lineage_first_hop_filter",
    f"""WITH {FEEDS_SQL}, one AS (
          SELECT 'n' || n_nationkey AS root, target AS node FROM nation
          JOIN feeds ON source = 'n' || n_nationkey AND starts_with(target, 's')),
        two AS (SELECT root, target AS node, count(*) AS n FROM one JOIN feeds ON source = node
                GROUP BY 1, 2)
        SELECT root, node, CAST(1 AS BIGINT) AS depth FROM (SELECT DISTINCT * FROM one)
        UNION ALL SELECT root, node, 2 FROM two""",
)
def lineage_first_hop_filter(spark, d):
    """Impact of each nation through its suppliers only."""
    return ln.downstream(
        feeds(spark, d), _roots(spark, d, "nation", "n_nationkey", "n"), 2,
        first_hop=F.col("target").startswith("s"),
    )


@query(
    "lineage_nearest",
    f"""WITH {FEEDS_SQL}, l1 AS (SELECT DISTINCT target AS root, source AS node FROM feeds
                                 WHERE starts_with(target, 's')),
        l2 AS (SELECT DISTINCT l1.root, f.source AS node FROM l1 JOIN feeds f ON f.target = l1.node)
        SELECT root, node, CAST(min(depth) AS BIGINT) AS depth FROM (
          SELECT *, 1 AS depth FROM l1 UNION ALL SELECT *, 2 FROM l2) GROUP BY 1, 2""",
)
def lineage_nearest(spark, d):
    roots = _roots(spark, d, "supplier", "s_suppkey", "s")
    return ln.nearest(ln.upstream(feeds(spark, d), roots, 2))


@query(
    "lineage_paths",
    f"""WITH RECURSIVE {FEEDS_SQL}, walk AS (
          SELECT 'p' || p_partkey AS root, 'p' || p_partkey AS node, ['p' || p_partkey] AS path FROM part
          UNION ALL
          SELECT root, feeds.source, list_append(path, feeds.source) FROM walk
          JOIN feeds ON feeds.target = walk.node)
        SELECT root, node, CAST(min(len(path)) - 1 AS BIGINT) AS depth,
               array_to_string(arg_min(path, {{'n': len(path), 'p': path}}), '>') AS path
        FROM walk WHERE len(path) > 1 GROUP BY 1, 2""",
)
def lineage_paths(spark, d):
    """All sources of every part with a shortest path, at any depth."""
    found = ln.reach(feeds(spark, d, distinct=False), _roots(spark, d, "part", "p_partkey", "p"))
    return found.withColumn("path", F.array_join("path", ">"))


@query(
    "lineage_closure",
    f"""WITH RECURSIVE {FEEDS_SQL}, walk AS (
          SELECT DISTINCT source, target, [source, target] AS path FROM feeds
          UNION ALL
          SELECT walk.source, feeds.target, list_append(path, feeds.target) FROM walk
          JOIN (SELECT DISTINCT source, target FROM feeds) feeds ON feeds.source = walk.target)
        SELECT source, target, CAST(min(len(path)) - 1 AS BIGINT) AS length,
               array_to_string(arg_min(path, {{'n': len(path), 'p': path}}), '>') AS path
        FROM walk GROUP BY 1, 2""",
)
def lineage_closure(spark, d):
    """All pairs of nodes with a path, by doubling."""
    return ln.closure(feeds(spark, d, distinct=False)).withColumn("path", F.array_join("path", ">"))


# From a customer's nation to the nations of most of its suppliers: a graph with cycles.
TRADE_SQL = """counted AS (
    SELECT c_nationkey AS a, s_nationkey AS b, count(*) AS n FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
  trade AS (SELECT a, b FROM counted x WHERE n = (SELECT max(n) FROM counted y WHERE y.a = x.a))"""


def trade(spark, d):
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_suppkey"])
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    customers = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    suppliers = read_table(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    counted = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .where("c_nationkey <> s_nationkey")
        .groupBy(F.col("c_nationkey").alias("source"), F.col("s_nationkey").alias("target"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    most = counted.groupBy("source").agg(F.max("n").alias("n"))
    return counted.join(most, ["source", "n"]).select("source", "target")


@query(
    "lineage_cyclic",
    f"""WITH RECURSIVE {TRADE_SQL}, walk AS (
          SELECT DISTINCT a AS root, a AS node, 0 AS depth FROM trade
          UNION
          SELECT root, b, depth + 1 FROM walk JOIN trade ON a = node WHERE depth < 25)
        SELECT root, node, CAST(min(depth) AS BIGINT) AS depth FROM walk
        WHERE root <> node GROUP BY 1, 2""",
)
def lineage_cyclic(spark, d):
    """What every nation reaches in a graph that has cycles."""
    edges = trade(spark, d)
    roots = edges.select(F.col("source").alias("root"))
    return ln.reach(edges, roots, up=False).select("root", "node", "depth")


@query(
    "lineage_cycles",
    f"""WITH RECURSIVE {TRADE_SQL}, walk AS (
          SELECT DISTINCT a, b, 1 AS depth FROM trade
          UNION SELECT walk.a, trade.b, depth + 1 FROM walk JOIN trade ON trade.a = walk.b WHERE depth < 25),
        pairs AS (SELECT DISTINCT a, b FROM walk WHERE a <> b)
        SELECT x.a AS node, least(x.a, min(x.b)) AS component FROM pairs x
        JOIN pairs y ON x.a = y.b AND x.b = y.a GROUP BY x.a""",
)
def lineage_cycles(spark, d):
    return ln.cycles(ln.closure(trade(spark, d)))


@query(
    "lineage_neighbours",
    f"""WITH {FEEDS_SQL}
        SELECT DISTINCT 'upstream' AS direction, source AS node FROM feeds WHERE target = 'n7'
        UNION ALL SELECT DISTINCT 'downstream', target FROM feeds WHERE source = 'n7'""",
)
def lineage_neighbours(spark, d):
    return ln.neighbours(feeds(spark, d), "n7")


# Column mappings from the customer table to the customer dimension.
MAPPINGS = [
    ("m1", "dim_customer", "dim_customer.c_custkey", "customer", "customer.c_custkey", "direct"),
    ("m2", "dim_customer", "dim_customer.c_name", "customer", "customer.c_name", "direct"),
    ("m3", "dim_customer", "dim_customer.c_mktsegment", "customer", "customer.c_mktsegment", "direct"),
    ("m4", "dim_customer", "dim_customer.last_priority", "orders", "orders.o_orderpriority", "derived"),
    ("m5", "dim_customer", "dim_customer.last_status", "orders", "orders.o_orderstatus", "derived"),
    ("m6", "dim_customer", "dim_customer.valid_to", None, None, "constant"),
    ("m7", "fact_sales", "fact_sales.customer_sk", "dim_customer", "dim_customer.customer_sk", "rename"),
]
MAPPING_SCHEMA = (
    "mapping_id string, target_entity_id string, target_attribute_id string, "
    "source_entity_id string, source_attribute_id string, mapping_type string"
)


def _mapping_values() -> str:
    def text(v):
        return "NULL" if v is None else f"'{v}'"

    return ", ".join(f"({', '.join(text(v) for v in m)})" for m in MAPPINGS)


@query(
    "lineage_enriched",
    f"""WITH {CATALOG_SQL}, m(mapping_id, te, ta, se, sa, mapping_type) AS (
          VALUES {_mapping_values()}),
        e AS (SELECT DISTINCT table_name FROM cat)
        SELECT mapping_id, te AS target_entity_id, mapping_type, e.table_name AS source_entity_name,
               s.column_name AS source_attr_name, s.is_primary_key AS source_is_key,
               t.column_name AS target_attr_name
        FROM m LEFT JOIN e ON m.se = e.table_name
        LEFT JOIN cat s ON m.sa = s.table_name || '.' || s.column_name
        LEFT JOIN cat t ON m.ta = t.table_name || '.' || t.column_name""",
)
def lineage_enriched(spark, d):
    columns = built_catalog(spark, d).select(
        F.concat_ws(".", "table_name", "column_name").alias("attribute_id"),
        F.col("table_name").alias("entity_id"), F.col("column_name").alias("name"), "is_primary_key",
    )
    entities = columns.select("entity_id", F.col("entity_id").alias("name")).distinct()
    mapping = rows(spark, MAPPINGS, MAPPING_SCHEMA)
    named = enrich_mappings(mapping, entities, columns)
    keys = columns.select(
        F.col("attribute_id").alias("source_attribute_id"), F.col("is_primary_key").alias("source_is_key")
    )
    return named.join(keys, "source_attribute_id", "left").select(
        "mapping_id", "target_entity_id", "mapping_type", "source_entity_name", "source_attr_name",
        "source_is_key", "target_attr_name",
    )


MAPPING_ROWS_SQL = f"""
  {fx.SNAPSHOTS_SQL.strip()}, j AS (
    SELECT b.c_custkey, a.c_custkey IS NULL AS fresh, a.last_priority AS ap,
           b.last_priority AS bp, a.last_status AS ast, b.last_status AS bst
    FROM snapshot_2_nulls b LEFT JOIN snapshot_1 a ON a.c_custkey = b.c_custkey),
  mapping AS (
    SELECT 'last_priority' AS target_entity_id, CASE WHEN bp IS NULL THEN 'constant'
             WHEN fresh OR ap IS DISTINCT FROM bp THEN 'derived' ELSE 'direct' END AS mapping_type
    FROM j
    UNION ALL SELECT 'last_status', CASE WHEN fresh OR ast IS DISTINCT FROM bst THEN 'derived'
             ELSE 'direct' END FROM j)"""


def _mapping_rows(spark, d):
    """How each attribute value of day 2 came about: kept, newly derived or empty."""
    old = fx.snapshot(spark, d, fx.DAY_1).select(
        "c_custkey", F.struct(*fx.TRACKED).alias("old")
    )
    pair = fx.snapshot(spark, d, fx.DAY_2, fx.NULL_PRIORITY).join(old, "c_custkey", "left")
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("target_entity_id"),
                    F.when(F.col(c).isNull(), "constant")
                    .when(F.col("old").isNull() | ~F.col(c).eqNullSafe(F.col(f"old.{c}")), "derived")
                    .otherwise("direct")
                    .alias("mapping_type"),
                )
                for c in fx.TRACKED
            ]
        )
    )
    return pair.select(cells.alias("m")).select("m.*")


@query(
    "mapping_profile",
    f"""WITH {MAPPING_ROWS_SQL}
        SELECT target_entity_id, count(*) FILTER (mapping_type = 'direct') AS direct,
               count(*) FILTER (mapping_type = 'rename') AS rename,
               count(*) FILTER (mapping_type = 'derived') AS derived,
               count(*) FILTER (mapping_type = 'aggregation') AS aggregation,
               count(*) FILTER (mapping_type = 'constant') AS constant
        FROM mapping GROUP BY 1""",
)
def mapping_profile(spark, d):
    return ln.mapping_profile(_mapping_rows(spark, d))


@query(
    "unmapped_columns",
    f"""WITH {FEEDS_SQL}, {NODES_SQL} SELECT node AS attribute_id, name FROM nodes
        WHERE node NOT IN (SELECT target FROM feeds)""",
)
def unmapped_columns(spark, d):
    attributes = key_nodes(spark, d).withColumnRenamed("node", "attribute_id")
    return ln.unmapped(
        attributes, feeds(spark, d).withColumnRenamed("target", "target_attribute_id")
    )


# ------------------------------------------------------------------- glossary


TERMS_SQL = """
  terms AS (
    SELECT 'term_' || replace(p_name, ' ', '_') AS term_id, p_name AS name,
           'Part of type ' || min(p_type) AS definition,
           list_sort(list(DISTINCT p_type)) AS synonyms,
           CASE WHEN min(p_type) = 'ECONOMY' THEN 'business' ELSE 'technical' END AS category
    FROM part GROUP BY p_name),
  targets AS (
    SELECT DISTINCT 'col:' || p_name AS target_id, replace(p_name, ' ', '_') AS name,
           'Stock of ' || p_name AS description FROM part
    UNION ALL SELECT DISTINCT 'tbl:' || p_name, p_name, NULL FROM part
    UNION ALL SELECT DISTINCT 'dim:' || p_name, 'dim ' || p_name, NULL FROM part
    UNION ALL SELECT 'type:' || p_type, 'type_' || lower(p_type), 'like ' || array_to_string(
                list_sort(list(DISTINCT p_name)), ', ') FROM part GROUP BY p_type
    UNION ALL SELECT DISTINCT 'word:' || split_part(p_name, ' ', 2), split_part(p_name, ' ', 2), NULL
              FROM part)"""


def terms(spark, d):
    """One term per part name, with all its types as synonyms."""
    part = read_table(spark, d, "part", ["p_name", "p_type"])
    first = part.groupBy("p_name").agg(
        F.min("p_type").alias("t"), F.sort_array(F.collect_set("p_type")).alias("types")
    )
    return first.select(
        F.concat(F.lit("term_"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("term_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("Part of type "), "t").alias("definition"),
        F.col("types").alias("synonyms"),
        F.when(F.col("t") == "ECONOMY", "business").otherwise("technical").alias("category"),
    )


def targets(spark, d):
    part = read_table(spark, d, "part", ["p_name", "p_type"])
    names = part.select("p_name").distinct()
    none = F.lit(None).cast("string").alias("description")
    name = F.col("p_name")
    word = F.split(name, " ")[1]
    underscored = F.replace(name, F.lit(" "), F.lit("_"))
    return (
        names.select(
            F.concat(F.lit("col:"), name).alias("target_id"), underscored.alias("name"),
            F.concat(F.lit("Stock of "), name).alias("description"),
        )
        .unionByName(names.select(F.concat(F.lit("tbl:"), name).alias("target_id"), name.alias("name"), none))
        .unionByName(
            names.select(
                F.concat(F.lit("dim:"), name).alias("target_id"),
                F.concat(F.lit("dim "), name).alias("name"), none,
            )
        )
        .unionByName(
            part.groupBy("p_type")
            .agg(F.array_join(F.sort_array(F.collect_set("p_name")), ", ").alias("n"))
            .select(
                F.concat(F.lit("type:"), "p_type").alias("target_id"),
                F.concat(F.lit("type_"), F.lower("p_type")).alias("name"),
                F.concat(F.lit("like "), "n").alias("description"),
            )
        )
        .unionByName(
            names.select(F.concat(F.lit("word:"), word).alias("target_id"), word.alias("name"), none)
            .distinct()
        )
    )


def auto_map_sql(min_conf: float) -> str:
    return f"""
  pairs AS (
    SELECT term_id, target_id, lower(t.name) AS tn, lower(g.name) AS gn, lower(description) AS ds,
           list_distinct(list_concat(string_split(lower(t.name), ' '),
             [lower(x) for x in synonyms])) AS tw,
           list_distinct(regexp_split_to_array(lower(g.name), '[_\\s]+')) AS gw
    FROM terms t CROSS JOIN targets g),
  scored AS (
    SELECT term_id, target_id, CAST(CASE WHEN tn = gn THEN 1.0
             WHEN contains(gn, tn) OR contains(tn, gn) THEN 0.9
             WHEN len(list_intersect(tw, gw)) > 0
               THEN CAST(0.7 AS DOUBLE) * len(list_intersect(tw, gw)) / greatest(len(tw), len(gw))
             WHEN contains(ds, tn) THEN 0.6 ELSE 0.0 END AS DOUBLE) AS score FROM pairs),
  mapped AS (SELECT * FROM scored WHERE score >= {min_conf})"""


@query(
    "term_search",
    f"""WITH {TERMS_SQL} SELECT term_id, name FROM terms
        WHERE category = 'business' AND (contains(lower(name), 'ring')
          OR contains(lower(definition), 'ring')
          OR len([x for x in synonyms if contains(lower(x), 'ring')]) > 0)""",
)
def term_search(spark, d):
    return gl.search_terms(terms(spark, d), "Ring", category="business").select("term_id", "name")


@query(
    "term_search_synonyms",
    f"""WITH {TERMS_SQL} SELECT term_id, name FROM terms
        WHERE contains(lower(name), 'promo') OR contains(lower(definition), 'promo')
           OR len([x for x in synonyms if contains(lower(x), 'promo')]) > 0""",
)
def term_search_synonyms(spark, d):
    return gl.search_terms(terms(spark, d), "promo").select("term_id", "name")


@query("term_auto_map", f"WITH {TERMS_SQL}, {auto_map_sql(0.7)} SELECT * FROM mapped")
def term_auto_map(spark, d):
    return gl.auto_map(terms(spark, d), targets(spark, d))


@query("cross_score", f"WITH {TERMS_SQL}, {auto_map_sql(0.3)} SELECT * FROM mapped")
def cross_score(spark, d):
    """All scores from 0.3 up, found without trying every pair."""
    return gl.auto_map(terms(spark, d), targets(spark, d), 0.3)


@query(
    "terms_for_entity",
    f"""WITH {TERMS_SQL}, {auto_map_sql(0.7)}
        SELECT DISTINCT target_id, term_id, name, category FROM mapped JOIN terms USING (term_id)""",
)
def terms_for_entity(spark, d):
    found = gl.auto_map(terms(spark, d), targets(spark, d))
    return gl.terms_for(found, terms(spark, d), "target_id").select(
        "target_id", "term_id", "name", "category"
    )


TITLE_SQL = (
    "array_to_string([upper(substring(x, 1, 1)) || lower(substring(x, 2)) "
    "for x in string_split(replace({0}, '_', ' '), ' ')], ' ')"
)
DESCRIBED = list(GIVEN_COLUMNS)


def _attribute_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}.{c}' AS attribute_id, '{table}' AS entity_id, '{c}' AS name,
            CASE WHEN count(DISTINCT {c}) = count(*) THEN ''
                 ELSE count(DISTINCT {c}) || ' values' END AS description FROM {table}"""
        for c, _ in _columns(GIVEN_COLUMNS[table])
    )


@query(
    "term_extract",
    f"""WITH attribute AS ({' UNION ALL '.join(_attribute_sql(t) for t in DESCRIBED)}),
        drafts AS (
          SELECT attribute_id AS id, name, description, 'attribute:' || attribute_id AS source
          FROM attribute WHERE description <> ''
          UNION ALL {' UNION ALL '.join(
              f"SELECT '{t}', '{t}', count(*) || ' rows', 'entity:{t}' FROM {t}" for t in DESCRIBED)})
        SELECT 'term_' || id AS term_id, {TITLE_SQL.format('name')} AS name,
               description AS definition, 'business' AS category, 'draft' AS status, source
        FROM drafts""",
)
def term_extract(spark, d):
    """Draft terms from columns and tables described by their measured profile."""
    measured = catalog(spark, {t: read_table(spark, d, t) for t in DESCRIBED})
    attribute = measured.select(
        F.concat_ws(".", "table_name", "column_name").alias("attribute_id"),
        F.col("table_name").alias("entity_id"), F.col("column_name").alias("name"),
        F.when(F.col("is_unique"), "")
        .otherwise(F.concat(F.col("distinct_count").cast("string"), F.lit(" values")))
        .alias("description"),
    )
    entity = measured.groupBy("table_name").agg(F.max("row_count").alias("n")).select(
        F.col("table_name").alias("entity_id"), F.col("table_name").alias("name"),
        F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("description"),
    )
    return gl.extract_terms(entity, attribute)


@query(
    "terms_for_attribute",
    f"""WITH {TERMS_SQL}, {auto_map_sql(0.85)}
        SELECT DISTINCT target_id, term_id, name FROM mapped JOIN terms USING (term_id)""",
)
def terms_for_attribute(spark, d):
    found = gl.auto_map(terms(spark, d), targets(spark, d), 0.85)
    return gl.terms_for(found, terms(spark, d), "target_id").select("target_id", "term_id", "name")
