"""Catalog classification on known column sets, and glossary matching by brute force."""

import random
import re

import pytest

from tablecraft.operators import catalog_rules as rules
from tablecraft.operators import glossary as gl
from tablecraft.sources.tables import CATALOG_SCHEMA


def make(spark, **tables):
    data = []
    for table, columns in tables.items():
        for i, col in enumerate(columns, start=1):
            name, kind, pk = (col + ("VARCHAR", False))[:3] if len(col) < 3 else col
            data.append((table, name, kind, i, True, pk))
    return spark.createDataFrame(data, CATALOG_SCHEMA)


def cols(names, types=None, pk=()):
    return [(n, (types or {}).get(n, "unknown"), n in pk) for n in names]


def test_scd_types(spark):
    types = {"valid_from": "TIMESTAMP", "valid_to": "TIMESTAMP", "is_current": "BOOLEAN"}
    cat = make(
        spark,
        dim_customer=cols(
            ["customer_sk", "customer_id", "customer_name", "email", "region", "valid_from",
             "valid_to", "is_current", "_load_ts"], types, ["customer_sk"],
        ),
        dim_contract=cols(
            ["contract_sk", "contract_id", "amount", "status", "business_date", "valid_from",
             "valid_to", "is_current", "system_date"]
        ),
        dim_product=cols(["product_id", "product_name", "category", "price"], pk=["product_id"]),
        dim_account=cols(["account_id", "_valid_from", "_valid_to", "_is_current"]),
    )
    fixed = {r.table_name: r for r in rules.classify_scd(cat).collect()}
    parity = {r.table_name: r for r in rules.classify_scd(cat, parity=True).collect()}
    one, two, three = (fixed[f"dim_{t}"] for t in ("customer", "contract", "product"))
    assert (one.scd_type, one.confidence, one.is_bi_temporal) == ("TYPE_2", 0.9, False)
    assert one.surrogate_key == "customer_sk"
    assert one.tracking_columns == ["customer_id", "customer_name", "email", "region"]
    assert (two.scd_type, two.confidence, two.is_bi_temporal) == ("TYPE_2", 0.95, True)
    assert (three.scd_type, three.confidence) == ("TYPE_1", 0.8)
    assert three.natural_keys == ["product_id"] and {f.subject for f in three.findings} == {"valid_from", "is_current"}
    assert parity["dim_account"].scd_type == "TYPE_1"
    assert fixed["dim_account"].scd_type == "TYPE_2"
    tags = {r.column_name: (r.role, r.confidence) for r in rules.tag_temporal(cat).collect()
            if r.table_name == "dim_customer"}
    assert tags["valid_from"] == ("valid_from", 1.0)
    assert tags["is_current"] == ("is_current", 0.9)
    assert tags["customer_sk"] == ("surrogate_key", 0.7)


def test_column_classes(spark):
    names = ["order_sk", "order_id", "customer_id", "amount", "status", "valid_from", "valid_to",
             "created_at", "updated_at"]
    got = {r.column_name: r.column_class
           for r in rules.classify_columns(make(spark, t=cols(names))).collect()}
    assert got == {
        "order_sk": "temporal", "order_id": "natural_key", "customer_id": "natural_key",
        "amount": "type2", "status": "type1", "valid_from": "temporal", "valid_to": "temporal",
        "created_at": "temporal", "updated_at": "audit",
    }


@pytest.fixture(scope="module")
def vault(spark):
    return make(
        spark,
        hub_customer=cols(["hk_customer", "customer_bk", "load_date", "record_source"],
                          pk=["hk_customer"]),
        link_customer_order=cols(
            ["hk_customer_order", "hk_customer", "hk_order", "load_date", "record_source"],
            pk=["hk_customer_order"],
        ),
        sat_customer_details=cols(
            ["hk_customer", "load_date", "customer_name", "email", "hash_diff", "record_source"],
            pk=["load_date"],
        ),
    )


def test_vault_constructs(vault):
    fixed = {r.table_name: r for r in rules.classify_vault(vault).collect()}
    parity = {r.table_name: r for r in rules.classify_vault(vault, parity=True).collect()}
    hub, link, sat = (fixed[t] for t in ("hub_customer", "link_customer_order", "sat_customer_details"))
    assert (hub.construct_type, hub.confidence, hub.business_keys) == ("hub", 1.0, ["customer_bk"])
    assert (link.construct_type, link.linked_hubs) == ("link", ["customer", "order"])
    assert (sat.construct_type, sat.parent_hub, sat.confidence) == ("satellite", "customer", 1.0)
    assert parity["sat_customer_details"].parent_hub is None


def test_vault_findings(vault):
    fixed = {(r.level, r.table_name, r.code, r.subject)
             for r in rules.validate_vault(rules.classify_vault(vault)).collect()}
    assert fixed == {
        ("issue", "link_customer_order", "unknown", "order")
    }
    parity = {(r.table_name, r.subject) for r in
              rules.validate_vault(rules.classify_vault(vault, True), parity=True).collect()}
    assert ("hub_customer", "satellite") in parity


def test_vault_by_columns(spark):
    cat = make(
        spark, customer=cols(["customer_hk", "customer_code"]), pairs=cols(["hk_a", "hk_b", "hk_c"]),
        detail=cols(["hdiff", "ldts", "x"]), other=cols(["x", "y"]),
    )
    got = {r.table_name: (r.construct_type, r.confidence, r.suggested_name)
           for r in rules.classify_vault(cat).collect()}
    assert got["customer"] == ("hub", 0.5, "hub_customer")
    assert got["pairs"][:2] == ("link", 0.5)
    assert got["detail"] == ("satellite", 0.5, "sat_detail")
    assert got["other"] == ("unknown", 0.0, None)


def test_vault_proposal(spark, vault):
    rel = spark.createDataFrame(
        [("a", "b", "many_to_many"), ("a", "c", "many_to_one")],
        "source string, target string, cardinality string",
    )
    cat = make(spark, a=cols(["id", "x"], pk=["id"]), b=cols(["id"], pk=["id"]), c=cols(["y"]))
    got = {(r.construct, r.name): r.columns for r in rules.propose_vault(cat, rel).collect()}
    assert got == {
        ("hub", "hub_a"): ["id"], ("satellite", "sat_a"): ["x"], ("hub", "hub_b"): ["id"],
        ("link", "link_a_b"): ["hub_a", "hub_b"],
    }


@pytest.fixture(scope="module")
def star(spark):
    i, d, v = "INTEGER", "DECIMAL(10,2)", "VARCHAR(50)"
    return make(
        spark,
        fact_sales=[("sale_sk", i, True), ("customer_sk", i, False), ("product_sk", i, False),
                    ("date_sk", i, False), ("quantity", i, False), ("unit_price", d, False),
                    ("total_amount", d, False)],
        dim_customer=[("customer_sk", i, True), ("customer_id", v, False), ("customer_name", v, False),
                      ("email", v, False), ("city", v, False), ("state", v, False),
                      ("country", v, False)],
    )


def test_star_constructs(star):
    got = {r.table_name: r for r in rules.classify_dimensional(star).collect()}
    fact, dim = got["fact_sales"], got["dim_customer"]
    assert fact.dimension_keys == ["customer_sk", "product_sk", "date_sk"]
    assert fact.measures == ["quantity", "unit_price", "total_amount"]
    assert (fact.grain, fact.confidence) == ("customer x product x date", 1.0)
    assert (dim.construct_type, dim.surrogate_key, dim.confidence) == ("dimension", "customer_sk", 1.0)
    assert len(dim.attributes) == 6
    findings = {(r.code, r.subject) for r in
                rules.validate_star(rules.classify_dimensional(star)).collect()}
    assert findings == {
        ("unknown", "product_sk"),
        ("unknown", "date_sk"),
    }


def test_star_proposal(spark):
    v, d, i = "VARCHAR", "DECIMAL", "INTEGER"
    cat = make(
        spark,
        customer=[("customer_id", v, True), ("name", v, False), ("email", v, False), ("city", v, False)],
        product=[("product_id", v, True), ("product_name", v, False), ("category", v, False),
                 ("price", d, False)],
        sales=[("sale_id", i, True), ("quantity", i, False), ("amount", d, False),
               ("discount", d, False)],
    )
    for parity, discount in ((False, "SUM"), (True, "COUNT")):
        got = rules.propose_star(cat, "fact_sales", parity).collect()
        dims = {r.name: (r.surrogate_key, r.natural_key, r.detail) for r in got if r.element == "dimension"}
        measures = {r.name: r.detail for r in got if r.element == "measure"}
        assert dims == {
            "dim_customer": ("customer_sk", "customer_id", "name,email,city"),
            "dim_product": ("product_sk", "product_id", "product_name,category"),
        }
        assert measures == {"sale_id": "SUM", "quantity": "SUM", "amount": "SUM", "discount": discount}


def test_numeric_types(spark):
    from pyspark.sql import functions as F

    kinds = ["INTEGER", "bigint", "DECIMAL(10,2)", "double", "POINT", "INTERVAL DAY", "VARCHAR", "REAL"]
    df = spark.createDataFrame([(k,) for k in kinds], "t string")
    fixed = [r[0] for r in df.select(rules.is_numeric(F.col("t"))).collect()]
    parity = [r[0] for r in df.select(rules.is_numeric(F.col("t"), True)).collect()]
    assert fixed == [True, True, True, True, False, False, False, True]
    assert parity == [True, True, True, True, True, True, False, True]


def test_hierarchy_levels(spark):
    got = {r.column_name: (r.is_hierarchy, r.hierarchy_level) for r in rules.star_columns(
        make(spark, d=cols(["geo_level2", "org_l3", "product_category", "name"]))).collect()}
    assert got == {
        "geo_level2": (True, 2), "org_l3": (True, 3), "product_category": (True, 0),
        "name": (False, None),
    }


def brute_score(name, synonyms, target, description):
    term, goal = name.lower(), target.lower()
    if term == goal:
        return 1.0
    if term in goal or goal in term:
        return 0.9
    mine = set(term.split()) | {x.lower() for x in synonyms}
    theirs = set(re.split(r"[_\s]+", goal))
    shared = len(mine & theirs)
    if shared:
        return 0.7 * shared / max(len(mine), len(theirs))
    return 0.6 if description and term in description.lower() else 0.0


@pytest.mark.parametrize("limit", [None, "5"])
@pytest.mark.parametrize("min_conf", [0.05, 0.2, 0.35, 0.6, 0.7, 0.9])
def test_auto_map_equals_all_pairs(spark, min_conf, limit):
    from tablecraft.session import GROUP_ROWS_KEY

    rng = random.Random(13)
    words = ["order", "date", "id", "customer", "key", "total", "net", "at", "x"]
    terms = [(f"t{i}", " ".join(rng.sample(words, rng.randint(1, 3))).title(),
              rng.sample(words, rng.randint(0, 2))) for i in range(25)]
    targets = [(f"g{i}", rng.choice(["_", " "]).join(rng.sample(words, rng.randint(1, 4))),
                rng.choice([None, "The " + " ".join(rng.sample(words, 3)), ""])) for i in range(40)]
    want = {}
    for tid, name, syn in terms:
        for gid, target, desc in targets:
            score = brute_score(name, syn, target, desc)
            if score >= min_conf:
                want[tid, gid] = round(score, 9)
    t = spark.createDataFrame(terms, "term_id string, name string, synonyms array<string>")
    g = spark.createDataFrame(targets, "target_id string, name string, description string")
    if limit:
        spark.conf.set(GROUP_ROWS_KEY, limit)
    try:
        got = {(r.term_id, r.target_id): round(r.score, 9) for r in gl.auto_map(t, g, min_conf).collect()}
    finally:
        spark.conf.unset(GROUP_ROWS_KEY)
    assert got == want


def test_auto_map_needs_a_threshold(spark):
    t = spark.createDataFrame([("a", "b", [])], "term_id string, name string, synonyms array<string>")
    g = spark.createDataFrame([("a", "b", "")], "target_id string, name string, description string")
    with pytest.raises(ValueError):
        gl.auto_map(t, g, 0)


def test_term_search_and_extraction(spark):
    terms = spark.createDataFrame(
        [("1", "Net Revenue", "Sales after returns", ["turnover"], "business"),
         ("2", "Order Date", "Day of sale", [], "business"), ("3", "Load", "x", None, "technical")],
        "term_id string, name string, definition string, synonyms array<string>, category string",
    )
    def ids(**kw):
        return sorted(r.term_id for r in gl.search_terms(terms, **kw).collect())

    assert ids(query="TURN") == ["1"]
    assert ids(query="turnover", synonyms=False) == []
    assert ids(query="sale") == ["1", "2"]
    assert ids(query="o", category="technical") == ["3"]
    entity = spark.createDataFrame([("e1", "sales_order", "Orders"), ("e2", "x", "")],
                                   "entity_id string, name string, description string")
    attribute = spark.createDataFrame(
        [("a1", "e1", "order_date", "Day"), ("a2", "e9", "lost", "y"), ("a3", "e1", "z", None)],
        "attribute_id string, entity_id string, name string, description string",
    )
    got = {r.term_id: (r.name, r.source, r.status) for r in gl.extract_terms(entity, attribute).collect()}
    assert got == {
        "term_e1": ("Sales Order", "entity:e1", "draft"),
        "term_a1": ("Order Date", "attribute:a1", "draft"),
    }
