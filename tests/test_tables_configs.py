import json

from cargoframe.operators import tables as TB
from cargoframe.sources import configs as CF


def test_attribute_upsert_rules(spark):
    target = spark.createDataFrame([("1", "P", '{"a": 1, "b": "2", "n": {"x": 2}, "z": null}'), ("2", "Q", '{"a": "x"}'), ("3", "R", None),
                                    ("4", "S", "{broken")],
                                   "shipment_id string, product_name string, attributes string")
    upd = spark.createDataFrame([
        ("1", "0", "", '{"b": "20", "c": "30"}'), ("1", "1", "New", '{"c": "31"}'), ("1", "2", "Later", "{}"),
        ("4", "0", "New", '{"a": true}'),
        ("9", "0", "Z", '{"a": "1"}'),        # not in target: ignored
        ("2", "0", "none", "{}")],            # nothing usable: dropped
        "shipment_id string, ord string, product string, attrs_json string")
    agg = TB.aggregate_updates(upd)
    out = {r.shipment_id: (r.product_name, r.attributes) for r in TB.attribute_upsert(target, agg).collect()}
    assert out["1"] == ("New", '{"a": 1, "b": "20", "n": {"x":2}, "z": null, "c": "31"}')
    assert out["4"] == ("New", "{broken")
    assert out["2"] == ("Q", '{"a": "x"}') and out["3"] == ("R", None) and "9" not in out
    again = {r.shipment_id: (r.product_name, r.attributes)
             for r in TB.attribute_upsert(TB.attribute_upsert(target, agg), agg).collect()}
    assert again == out  # idempotent


def test_warehouse_rows(spark):
    df = spark.createDataFrame([("", "True", "1.5", "x"), ("a", "no", "bad", "y")],
                               "shipment_origin string, is_multi_product_shipment string, weight_in_kg string, attributes_struct string")
    got = [tuple(r) for r in TB.warehouse_rows(df, {"is_multi_product_shipment": "boolean", "weight_in_kg": "double"}).collect()]
    assert got == [(None, True, 1.5), ("a", False, None)]


def test_parse_attribute_schema(spark):
    doc = json.dumps({"_meta": "x", "0901": {"version": "", "products": {
        "Green": {"attributes": {"Grade": [" A ", "", "B"], "Bad": "notalist", "Empty": []}},
        "NoAttrs": {"attributes": {"Bad": 1}}, "NotObj": 5}}})
    out = CF.parse_attribute_schema(spark.createDataFrame([(doc,)], "text string"), default_version="v0")
    got = sorted((r.product, r.attr, r.attr_ord, r.value_ord, r.value, r.version) for r in out.collect())
    assert got == [("Green", "Empty", 1, None, None, "v0"), ("Green", "Grade", 0, 0, "A", "v0"),
                   ("Green", "Grade", 0, 1, "B", "v0")]


def test_flat_classifications_skip_bad_keys(spark):
    doc = json.dumps({"0901_Green_Coffee": {"bean": {"Grade": "A"}, "x": "notdict"}, "nokey": {"g": {"a": "b"}}})
    out = CF.parse_flat_classifications(spark.createDataFrame([(doc,)], "text string")).collect()
    assert [(r.hs_code, r.category, r.goods_shipped, r.attr, r.value) for r in out] == \
        [("0901", "Green_Coffee", "bean", "Grade", "A")]
