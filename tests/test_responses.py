from cargoframe.operators import responses as RS


def test_product_labels_positional(spark):
    items = spark.createDataFrame([(b, p, f"g{b}{p}") for b in range(4) for p in range(3)],
                                  "batch long, pos_in_batch int, goods_shipped string")
    resp = spark.createDataFrame([
        (0, '```json\n{"classifications": ["A", "B", "C"]}\n```'),
        (1, '{"classifications": ["A"]}'),               # short -> padded
        (2, '{"classifications": ["A", "B", "C", "D"]}'),  # long -> truncated
        (3, "no json here")], "batch long, text string")
    got = {(r.batch, r.pos_in_batch): r.category for r in RS.validate_product_labels(items, resp, ["batch"]).collect()}
    assert got[(0, 2)] == "C" and got[(1, 0)] == "A" and got[(1, 1)] == "Unclassified"
    assert got[(2, 2)] == "C" and got[(3, 0)] == "Unclassified"


def _schema_vals(spark):
    return spark.sql("""SELECT 'p' AS product, array(named_struct('attr_ord', 0, 'attr', 'Color'),
                                                      named_struct('attr_ord', 1, 'attr', 'Size')) AS attrs,
                               map('Color', array('Red', 'Blue'), 'Size', array('Small')) AS allowed""")


def test_attribute_validation_rules(spark):
    goods = spark.createDataFrame([("p", 0, 0, "g0"), ("p", 0, 1, "g1"), ("p", 0, 2, "g2"), ("p", 1, 0, "h0")],
                                  "product string, batch long, pos_in_batch int, goods_shipped string")
    resp = spark.createDataFrame([
        ("p", 0, 'x {"items": [{"attributes": {"Color": {"value": "Blue"}, "Size": "Huge"}},'
                 ' {"attributes": {"Color": {"custom": "Teal"}}}]} y'),
        ("p", 1, '{"items": [{"attributes": {"Color": "' + "r" * 61 + '"}}]}')], "product string, batch long, text string")
    v = RS.validate_attribute_responses(goods, resp, _schema_vals(spark), ["product", "batch"], ["product"])
    got = {(r.goods_shipped, r.attr): (r.resp, r.invalid, r.out_of_schema, r.batch_failed, r.has_item) for r in v.collect()}
    assert got[("g0", "Color")] == ("Blue", False, False, False, True)
    assert got[("g0", "Size")] == ("None", True, False, False, True)        # out of schema -> coerced
    assert got[("g1", "Color")] == ("Teal", False, True, False, True)       # custom kept, flagged
    assert got[("g1", "Size")] == ("None", False, False, False, True)       # missing key
    assert got[("g2", "Color")] == (None, False, False, False, False)       # no item: padding
    assert got[("h0", "Color")][3] is True and got[("h0", "Color")][0] is None  # > 60 chars fails the batch


def test_label_with_user_function(spark):
    b = spark.createDataFrame([(0, "a"), (1, "b")], "batch long, prompt string")
    out = RS.label_with(b, lambda ps: [p.upper() for p in ps], ["batch"])
    assert sorted((r.batch, r.text) for r in out.collect()) == [(0, "A"), (1, "B")]
