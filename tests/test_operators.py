"""Aggregation, ranking and data-quality operators against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata.operators import quality
from lakestrata.operators.aggregate import (distribution_map, latest_per_key, share_of_total,
                                            top_values)
from lakestrata.operators.nested import parse_listing_json
from lakestrata.operators.rank import ranks_with_cutoff, top_n_per_group
from tests.conftest import SF0001, rows


def test_distribution_map_skips_null_keys_and_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("a", None), ("b", None)],
                               "g string, k string")
    got = {r["g"]: dict(r["m"]) for r in distribution_map(df, ["g"], "k", "m").collect()}
    assert got == {"a": {"x": 2, "y": 1}}


def test_top_values_filters_empty_and_breaks_ties_by_larger_value(spark):
    df = spark.createDataFrame([
        ("g", ["a", "b"]), ("g", ["b", "c"]), ("g", ["c", "", None]), ("g", []), ("g", None),
        ("h", ["z", "y", "x", "w", "v", "u"]), ("h", ["", None])],
        "g string, tags array<string>")
    got = {r["g"]: r["t"] for r in top_values(df, ["g"], "tags", "t", 5).collect()}
    assert got["g"] == ["c", "b", "a"]            # c:2, b:2 -> larger first; then a:1
    assert got["h"] == ["z", "y", "x", "w", "v"]  # all 1 -> descending, capped at 5


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 5, "c")],
                               "k string, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"]), "k", "v") == [("j", "c"), ("k", "b")]
    assert rows(quality.dedupe_first(df, "k", ["t"]), "k", "v") == [("j", "c"), ("k", "a")]


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([("d", "a", 1), ("d", "b", 1), ("d", "c", 1)],
                               "ds string, r string, n long")
    out = share_of_total(df, ["ds"], "n", "p")
    assert abs(out.agg(F.sum("p")).first()[0] - 100.0) <= 0.01 * 3


def _brute(df, part, specs, cutoff):
    out = df
    for name, spec in specs.items():
        order = [F.col(c).asc() if a else F.col(c).desc() for c, a in spec]
        out = out.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    cond = None
    for name in specs:
        c = F.col(name) <= cutoff
        cond = c if cond is None else cond | c
    return out.where(cond)


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_with_cutoff_matches_row_number(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["d1", "d2", None]), rnd.choice(["a", "b", None]), f"k{i}",
             rnd.randint(0, 5), rnd.choice([None, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame(data, "ds string, city string, key string, x long, y long")
    specs = {"rx": [("x", False), ("city", True), ("key", True)],
             "ry": [("y", False), ("city", True), ("key", True)]}
    got = ranks_with_cutoff(df, ["ds"], specs, 7)
    want = _brute(df, ["ds"], specs, 7)
    cols = ["ds", "city", "key", "x", "y", "rx", "ry"]
    assert rows(got, *cols) == rows(want, *cols)
    # ranks are 1..n without gaps among the kept top rows
    for d in ("d1", "d2", None):
        rx = sorted(r["rx"] for r in got.where(F.col("ds").eqNullSafe(F.lit(d))).collect()
                    if r["rx"] <= 7)
        assert rx == list(range(1, len(rx) + 1))


def test_top_n_per_group(spark):
    df = spark.createDataFrame([("g", i) for i in range(20)] + [("h", 1)], "g string, v int")
    out = top_n_per_group(df, ["g"], [F.col("v").desc()], 3, "rank")
    assert rows(out, "g", "v", "rank") == [("g", 17, 3), ("g", 18, 2), ("g", 19, 1), ("h", 1, 1)]


def test_validate_and_first_seen_valid_after_invalid(spark):
    cols = "source string, house_id string, house_url string, city string, district string, community string, " \
           "total_price double, unit_price double, area_sqm double, t int"
    df = spark.createDataFrame([
        ("s", "h1", "u", "c", "d", None, 1.0, 1.0, 1.0, 1),   # invalid: no community
        ("s", "h1", "", "c", "d", "m", 1.0, 1.0, 1.0, 2),     # valid later copy (an empty string is allowed)
        (None, "h2", "u", "c", "d", "m", None, 1.0, 1.0, 3),  # two reasons
    ], cols)
    valid, rejected = quality.validate(df)
    reasons = {r["house_id"] + str(r["t"]): r["reasons"] for r in rejected.collect()}
    assert reasons == {"h11": ["missing:community"],
                       "h23": ["missing:source", "not_numeric:total_price"]}
    first = quality.dedupe_first(valid, "house_id", ["t"])
    assert rows(first, "house_id", "t") == [("h1", 2)]


def test_anti_delivered_and_blacklist(spark):
    df = spark.createDataFrame([("a", "X"), ("b", None), ("c", "Y")], "k string, city string")
    delivered = spark.createDataFrame([("a",)], "k string")
    assert rows(quality.anti_delivered(df, delivered, "k"), "k") == [("b",), ("c",)]
    # NOT IN drops the NULL city too
    assert rows(quality.city_blacklist(df, ("X",)), "k") == [("c",)]


def test_apply_contract_defaults(spark):
    df = spark.createDataFrame([(None, None, None, "12.5")],
                               "room_num int, tags array<string>, version string, total_price string")
    r = quality.apply_contract(df).first()
    assert (r["room_num"], r["tags"], r["version"], r["total_price"]) == (0, [], "1.1", 12.5)


def test_medians_are_exact_at_every_group_size(spark):
    """Hot groups, ties, negative and null values, null keys; against sorting each group."""
    import numpy as np
    from lakestrata.operators.aggregate import with_medians
    r = np.random.default_rng(3)
    data = {None: r.normal(0, 1e6, 30_000), "hot": r.integers(0, 500, 120_000) * 1.0, "one": np.array([7.5]),
            "even": np.array([4.0, 1.0, 3.0, 2.0]), "skew": np.concatenate([np.zeros(4000), r.lognormal(0, 9, 3999)]),
            "const": np.full(25_000, 5e-7), "narrow": 1e9 + np.arange(50_001) / 1024.0}
    pairs = [(k, float(v)) for k, vs in data.items() for v in vs] + [("hot", None)] * 50 + [("none", None)] * 3
    df = spark.createDataFrame(pairs, "k string, v double").repartition(8).withColumn("w", (-F.col("v")).cast("double"))
    got = {x["k"]: x for x in with_medians(df, ["k"], {"v": "mv", "w": "mw"}, [F.count(F.lit(1)).alias("n")]).collect()}
    assert len(got) == len(data) + 1 and got["none"]["mv"] is None and got["none"]["n"] == 3
    for k, vs in data.items():
        s = np.sort(vs)
        assert got[k]["mv"] == s[(len(s) + 1) // 2 - 1], k
        assert got[k]["mw"] == np.sort(-s)[(len(s) + 1) // 2 - 1], k


def test_medians_reduce_in_every_task(spark):
    """No task gets the rows of a group: the second pass shuffles counts of the bracket, after a partial aggregate."""
    from lakestrata.operators.aggregate import with_medians
    from tests.test_plans import plan
    df = spark.range(200_000).selectExpr("if(id % 2 < 2, concat('h', id % 1), 'x') k", "cast(id as double) v")
    p = plan(with_medians(df, ["k"], {"v": "m"}, []))
    assert "partial_count(1)" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_day_range_reaches_the_scan_and_changes_nothing(spark, tmp_dir):
    """Zones with changes of the clocks near midnight: the pushed range and the day key agree with the day key alone."""
    from lakestrata.plans import listings
    from tests.test_plans import plan
    base = 1_540_000_000            # autumn 2018
    df = spark.range(0, 120 * 24 * 4).selectExpr(f"{base} + id * 900 AS event_time", "'A' AS city", "'x' AS raw_p2_desc",
                                                  "cast(null as string) AS raw_p1_desc", "array('t') AS tags", "1 AS unit_price")
    from lakestrata.schemas import TABLES
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in TABLES["ods_ershoufang"].fields])
    full.write.parquet(f"{tmp_dir}/ods")
    ods = spark.read.parquet(f"{tmp_dir}/ods")
    for zone in ("UTC", "America/Sao_Paulo", "America/St_Johns", "Asia/Amman", "Europe/Berlin", "GMT+8", "Pacific/Apia"):
        whole = listings.listing_fact(ods, (), zone)
        for since, until in (("20181104", "20181104"), ("20181027", "20181104"), (None, "20181030"), ("20190101", None)):
            part = listings.listing_fact(ods, (), zone, since, until)
            want = listings.since_until(whole, since, until)
            assert part.select("event_time", "ds").exceptAll(want.select("event_time", "ds")).isEmpty()
            assert part.count() == want.count() > 0
    p = plan(listings.listing_fact(ods, (), "Asia/Shanghai", "20181104", "20181104"))
    assert "GreaterThanOrEqual(event_time," in p and "LessThan(event_time," in p


def test_contract_fills_header_and_attributes_the_same_way_twice(spark):
    from lakestrata.operators.quality import apply_contract
    df = spark.createDataFrame([(None, None, "h1", None), (None, 5, "h2", {"a": "b"}), ("t", 6, "h1", None)],
                               "trace_id string, event_time long, house_id string, raw_info map<string,string>")
    one, two = ({r["house_id"] + str(r["event_time"])[:1]: r for r in apply_contract(df).collect()} for _ in range(2))
    made = [r["trace_id"] for r in one.values()]
    assert len(set(made)) == 3 and "t" in made and sorted(made) == sorted(r["trace_id"] for r in two.values())
    assert all(r["event_time"] is not None and r["raw_info"] is not None for r in one.values())


def test_a_filter_on_message_fields_does_not_parse_again(spark):
    from lakestrata import catalog
    plan = catalog.RAW["listing_json_parse"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    values = spark.createDataFrame([("{\"core_data\":{\"house_id\":\"h\",\"unit_price\":\"n/a\"}}", 1), ("broken", 2), (None, 3)], "value string, n int")
    got = parse_listing_json(values).select("n", "core_data.house_id", "core_data.unit_price", "header")
    assert rows(got) == [(1, "h", None, None), (2, None, None, None), (3, None, None, None)]


def test_listing_moves_lines_twice_and_gives_the_rows_of_its_sql(spark):
    from lakestrata import fixtures
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    plain = spark.sql(fixtures.LISTING_SQL, **{t: fixtures.table(spark, SF0001, t) for t in names})
    got = fixtures.listing(spark, SF0001)
    assert got.columns == plain.columns and got.count() == plain.count()
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    joins = [line.strip(" :+-") for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert any("o_custkey" in j for j in joins) and not any("o_custkey" in j for j in joins[:-1])


def test_first_seen_sorts_only_what_it_returns(spark):
    from lakestrata import catalog_more
    plan = catalog_more.first_seen(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "row_number" in line)
    assert "total_price" not in window and "raw_p1_desc" not in window


def test_validate_makes_no_reasons_for_valid_rows(spark):
    cols = list(quality.REQUIRED_STRINGS) + list(quality.REQUIRED_NUMBERS) + ["room_num"]
    good, missing, text = ["s"] * 6 + ["1", "2", "3", "4"], [None] + ["s"] * 5 + ["1", "x", "3", None], ["s"] * 6 + ["1", "2", "3", "n/a"]
    df = spark.createDataFrame([good, missing, text], ", ".join(f"{c} string" for c in cols))
    valid, rejected = quality.validate(df)
    assert valid.columns == cols and [list(r) for r in valid.collect()] == [good]
    assert sorted(r.reasons for r in rejected.select("reasons").collect()) == [
        ["missing:source", "not_numeric:unit_price"], ["not_integer:room_num"]]
    assert "filter(array" not in valid._jdf.queryExecution().optimizedPlan().toString()


def test_rules_on_typed_columns_read_no_text(spark):
    typed = spark.createDataFrame(
        [("s", "h", "u", "c", "d", "q", 1.5, 2, 3.0, 4, 2000), ("s", "h", "u", None, "d", "q", None, 2, 3.0, None, None)],
        "source string, house_id string, house_url string, city string, district string, community string, total_price double, "
        "unit_price int, area_sqm double, room_num int, build_year long")
    tagged = quality.with_reasons(typed)
    assert [r.reasons for r in tagged.collect()] == [[], ["missing:city", "not_numeric:total_price"]]
    assert "cast(" not in tagged._jdf.queryExecution().optimizedPlan().toString()
    text = quality.with_reasons(typed.withColumn("room_num", F.lit("n/a")).withColumn("unit_price", F.lit("x")))
    assert text.first().reasons == ["not_numeric:unit_price", "not_integer:room_num"]


def test_packed_texts_come_back_as_they_were(spark):
    from lakestrata.operators.texts import pack_texts, text_columns, unpack_texts
    given = [(1, "k", "a", None, ""), (2, "k", None, None, None), (3, "k", "", "", ""), (4, "k", "x\x01y", "b", "c"),
             (5, "k", "\x02", "b", None), (6, "k", "早\n", "\\x01", " ")]
    df = spark.createDataFrame(given, "id int, key string, a string, b string, c string")
    texts = text_columns(df, ["key"])
    packed = pack_texts(df, texts)
    assert texts == ["a", "b", "c"] and packed.where("__texts IS NOT NULL AND coalesce(a, b, c) IS NULL").count() == 4
    assert rows(unpack_texts(packed, texts).select(*df.columns)) == given
    raw = df.selectExpr("id", "cast(X'FF41' AS string) a", "b")  # no valid text
    assert unpack_texts(pack_texts(raw, ["a", "b"]), ["a", "b"]).where("cast(a AS binary) = X'FF41'").count() == len(given)
