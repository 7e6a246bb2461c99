from pyspark.sql import functions as F

from cargoframe.operators import dictionary as D


def _schema(spark, attrs):
    rows = [("p", a, i, v, j) for i, (a, vals) in enumerate(attrs) for j, v in enumerate(vals)]
    return spark.createDataFrame(rows, "product string, attr string, attr_ord int, value string, value_ord int")


def _match(spark, attrs, texts, guard=False):
    d = D.compile_dictionary(_schema(spark, attrs), ["product"])
    g = spark.createDataFrame([("p", t) for t in texts], "product string, goods_shipped string")
    m = D.dictionary_match(g, d, ["product"], negation_guard=guard)
    return {(r.goods_shipped, r.attr): r.value for r in m.collect()}


def test_longest_value_wins_and_boundaries(spark):
    got = _match(spark, [("Item", ["Widget", "Red Widget"]), ("Color", ["Red"])],
                 ["red widget box", "redwidget", "blue widget"])
    assert got == {("red widget box", "Item"): "Red Widget", ("red widget box", "Color"): "Red",
                   ("blue widget", "Item"): "Widget"}


def test_non_parboiled(spark):
    without = _match(spark, [("Process", ["Parboiled"])], ["non parboiled rice"])
    assert without == {("non parboiled rice", "Process"): "Parboiled"}  # the reference's behaviour
    withv = _match(spark, [("Process", ["Parboiled", "Non Parboiled"])], ["non parboiled rice"])
    assert withv == {("non parboiled rice", "Process"): "Non Parboiled"}


def test_density_values(spark):
    got = _match(spark, [("Density", ["500 G/L"])], ["coffee 500gr/l grade", "coffee 1500gr/l", "500 grams / liter"])
    assert got == {("coffee 500gr/l grade", "Density"): "500 G/L", ("500 grams / liter", "Density"): "500 G/L"}


def test_density_matches_any_number(spark):
    got = _match(spark, [("Density", ["500-550 G/L"])], ["black pepper 550 g/l", "pepper 500\xa0gr/l", "pepper 525 g/l"])
    assert got == {("black pepper 550 g/l", "Density"): "500-550 G/L", ("pepper 500\xa0gr/l", "Density"): "500-550 G/L"}


def test_unicode_spaces_separate_words(spark):
    got = _match(spark, [("Item", ["Red Widget"])], ["RED\xa0WIDGET", "red\u3000\u2009widget box"])
    assert set(got.values()) == {"Red Widget"} and len(got) == 2


def test_short_values_and_percent(spark):
    got = _match(spark, [("Broken", ["5%", "15%", "50%"])], ["rice (15% broken)", "5% broken"])
    assert got == {("rice (15% broken)", "Broken"): "15%"}


def test_ascii_only_boundaries(spark):
    # accented letters are not token characters, so they act as boundaries
    got = _match(spark, [("Color", ["Red"])], ["éredé", "xredx"])
    assert got == {("éredé", "Color"): "Red"}


def test_negation_guard(spark):
    attrs = [("Item", ["Widget", "Red Widget"]), ("Color", ["Red", "Blue"])]
    got = _match(spark, attrs, ["not red widget", "cannot blue", "red widget"], guard=True)
    assert got == {("not red widget", "Item"): "Widget", ("red widget", "Item"): "Red Widget",
                   ("red widget", "Color"): "Red"}


def test_heuristic_first_occurrence_only(spark):
    sch = _schema(spark, [("Broken", ["5%", "15%"])])
    d = D.compile_dictionary(sch.filter(F.col("value") == "5%"), ["product"])
    g = spark.createDataFrame([("p", "15% broken 5%"), ("p", "rice, 5% broken")], "product string, goods_shipped string")
    r = {x.goods_shipped: (x.value, x.source) for x in D.resolve_attributes(g, d, ["product"]).collect()}
    assert r == {"15% broken 5%": ("None", "none"), "rice, 5% broken": ("5%", "heuristic")}


def test_token_join_equals_the_matcher(spark):
    import random
    rng = random.Random(4)
    words = ["red", "blue", "x", "5%", "10%", "(box)", "non", "gear-box", "éred", "c++", "++", "%%%", "ünï", "not", "500", "g/l", "500gr/l", "a.b"]
    phrase = lambda n: rng.choice([" ", ", ", "-", ""]).join(rng.choice(words) for _ in range(rng.randint(1, n)))
    rows = [(k, f"A{j % 4}", j % 4, phrase(3), j) for k in ("p", "q", None) for j in range(80)]
    rows += [("p", "D", 9, "500-550 G/L", 0), ("p", "E", 10, "+++", 0), ("p", "E", 10, "éé é", 1)]
    schema = spark.createDataFrame(rows, "product string, attr string, attr_ord int, value string, value_ord int").filter("product IS NOT NULL")
    texts = [(k, phrase(8), i) for i, k in enumerate(("p", "q", "p", "r", None) * 60)] + [("p", None, 0), ("p", "", 1), ("p", "tea 550 gr / l", 2), ("p", "éé é +++", 3)]
    texts += [("p", "red not blue 5%", 4)] * 3 + [("p", "word " * 3000 + "red", 5)]
    goods = spark.createDataFrame(texts, "product string, goods_shipped string, n int")
    plain = D.compile_dictionary(schema, ["product"])
    for guard in (False, True):
        want = sorted(map(tuple, D.dictionary_match(goods, plain, ["product"], negation_guard=guard).collect()), key=str)
        got = sorted(map(tuple, D.match_by_token(goods, D.value_index(schema, ["product"]), ["product"], negation_guard=guard).collect()), key=str)
        assert got == want and len(got) > 100
    assert D.match_by_token(goods.limit(0), D.value_index(schema, ["product"]), ["product"]).count() == 0
    assert D.match_by_token(goods, D.value_index(schema.limit(0), ["product"]), ["product"]).count() == 0


def test_marked_match_equals_the_bounded_pattern(spark):
    """The substring test on marked texts says what the pattern says."""
    import random
    import re

    from cargoframe.functions.text import bounded_pattern, marked_value, match_text, token_marked, value_pattern
    rng = random.Random(6)
    pairs = [("".join(rng.choice("ab1 %-é😀") for _ in range(rng.randint(1, 4))).strip() or "a",
              "".join(rng.choice("ab1 %-é😀") for _ in range(rng.randint(0, 12)))) for _ in range(3000)]
    df = spark.createDataFrame([(" ".join(v.split()), t) for v, t in pairs], "v string, t string")
    rows = df.select("v", "t", (F.instr(token_marked(match_text("t")), marked_value("v")) > 0).alias("got"),
                     bounded_pattern(value_pattern("v")).alias("p"), match_text("t").alias("m")).collect()
    for r in rows:
        want = re.search("(^|[^a-z0-9])" + re.escape(r["v"]) + "($|[^a-z0-9])", r["m"]) is not None
        assert r["got"] == want, r
    assert any(r["got"] for r in rows)


def test_no_pattern_per_row_but_for_density(spark):
    d = D.compile_dictionary(_schema(spark, [("Item", ["Red Widget", "C++"]), ("Density", ["500 G/L"])]), ["product"])
    entries = {e["value"]: e["pattern"] for e in d.collect()[0]["dict"]}
    assert entries["Red Widget"] is None and entries["C++"] is None and entries["500 G/L"] is not None
