import json

from pyspark.sql import functions as F

from assayer.functions import params as P
from assayer.operators import records as R


def rows(spark, texts):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)], "record_id string, input_schema string"
    )


def render(spark, texts):
    df = rows(spark, texts).select(F.col("record_id").cast("int").alias("i"), P.render_params("input_schema").alias("o"))
    return [r.o for r in df.orderBy("i").collect()]


def test_json_object_predicate(spark):
    cases = {
        "{}": True, "[]": False, '"s"': False, "null": False, '{"a":1,}': False, "{'a':1}": False,
        '{"a":1} x': False, '{"a":1}, {}': False, '{"a":1}] x': False, '{"a":1}{}': False,
        '{"a":NaN}': True, '{"a":1,"a":2}': True, '{"a":"\t"}': False, '{"a":01}': False, "1": False,
        ' {"a":1}\n': True, '"{}"': False, '{"_":5}': True, "[{}]": False, '{"a":1}//x': False,
        "{},{}]": False, '{"properties":{"a":{}}},{}] junk': False, "{},{}] [1": False, '{"a":1}\n,{"b":2}]': False,
    }
    df = rows(spark, cases).select(
        "record_id", F.coalesce(P.is_json_object("input_schema"), F.lit(False)).alias("o")
    )
    got = {list(cases)[int(r.record_id)]: r.o for r in df.collect()}
    assert got == cases


def test_blank_is_not_unparsable(spark):
    df = rows(spark, ["", "  ", " ", "x", "[1]", "{}"]).select(
        F.col("record_id").cast("int").alias("i"), P.is_unparsable("input_schema").alias("o")
    )
    assert [r.o for r in df.orderBy("i").collect()] == [False, False, False, True, True, False]


def test_no_parameters_and_unparsable(spark):
    texts = ["", " \t", "{}", '{"properties":{}}', '{"properties":null}', '{"properties":5}',
             '{"properties":[1]}', "[1]", "{bad", '"x"']
    assert render(spark, texts) == ["no parameters"] * 7 + ["unparsable schema"] * 3


def schema(specs, required=None):
    return json.dumps({"properties": specs, **({"required": required} if required is not None else {})})


def test_lines(spark):
    cases = {
        schema({"x": {"type": "string"}}, ["x"]): "- x (string, required)",
        schema({"x": {"type": ["string", "null"]}}): "- x (string|null, optional)",
        schema({"x": {}}): "- x (any, optional)",
        schema({"x": {"enum": None}}): "- x (enum, optional)",
        schema({"x": {"oneOf": []}}): "- x (union, optional)",
        schema({"x": {"anyOf": None}}): "- x (union, optional)",
        schema({"x": {"type": None, "enum": [1]}}): "- x (enum, optional) enum[1]",
        schema({"x": 5}, ["x"]): "- x (required)",
        schema({"x": "{}"}): "- x (optional)",
        schema({"x": None}): "- x (optional)",
        schema({"x": [1]}): "- x (optional)",
        schema({"x": {"type": "a", "enum": []}}): "- x (a, optional)",
        schema({"x": {"type": "a", "enum": "b"}}): "- x (a, optional)",
        schema({"x": {"type": "a", "enum": [True, None, 1.0, 2.5, "s", 7]}}):
            "- x (a, optional) enum[True, None, 1.0, 2.5, s, 7]",
        schema({"x": {"type": "a", "enum": [1, 2, 3, 4, 5, 6, 7]}}): "- x (a, optional) enum[1, 2, 3, 4, 5, 6]",
        schema({"x": {"type": "a", "enum": [False, 12345678901, -0.5, 1e20]}}):
            "- x (a, optional) enum[False, 12345678901, -0.5, 1e+20]",
        schema({"x": {"type": "a", "description": "  many   words\n"}}): "- x (a, optional): many words",
        schema({"x": {"type": "a", "description": " \t"}}): "- x (a, optional)",
        schema({"x": {"type": "a", "description": 5}}): "- x (a, optional)",
        schema({"x": {"type": "a", "description": "d" * 141}}): "- x (a, optional): " + "d" * 140,
        schema({"x": {"type": "a"}}, "x"): "- x (a, optional)",
        schema({"x": {"type": "a"}}, True): "- x (a, optional)",
        schema({"x": {"type": "a"}}, [1, None, "x"]): "- x (a, required)",
        schema({"x": {"type": []}}): "- x (, optional)",
        schema({"x": {"type": 5}}): "- x (5, optional)",
        schema({"$ref.a b": {"type": "q'\"\\"}}): "- $ref.a b (q'\"\\, optional)",
        '{"properties":{"b":{"type":"1"},"a":{"type":"2"},"b":{"type":"3"}}}':
            "- b (3, optional)\n- a (2, optional)",
    }
    assert render(spark, list(cases)) == list(cases.values())


def test_cap(spark):
    for n in (0, 1, 12, 13, 14):
        text = render(spark, [schema({f"p{i}": {"type": "t"} for i in range(n)})])[0].split("\n")
        if n == 0:
            assert text == ["no parameters"]
        else:
            shown = [f"- p{i} (t, optional)" for i in range(min(n, 12))]
            more = [f"- ... and {n - 12} more parameter(s)"] if n > 12 else []
            assert text == shown + more


def test_table_and_text_agree(spark):
    texts = [schema({f"p{i}": {"type": "t", "enum": [i]} for i in range(14)}, ["p3"]), "{}", "[1]",
             schema({"z": 1, "a": {"description": "x"}})]
    lines = R.shown_param_lines(R.params_table(rows(spark, texts)))
    grouped = {}
    for r in lines.orderBy("record_id", "position").collect():
        grouped.setdefault(r.record_id, []).append(r.line)
    rendered = {str(i): t for i, t in enumerate(render(spark, texts))}
    assert {k: "\n".join(v) for k, v in grouped.items()} == {k: rendered[k] for k in grouped}
    assert set(grouped) == {"0", "3"}


def test_floats_as_python_spells_them(spark):
    values = ["1e20", "0.00001", "2.50", "-1.5e-7", "1e16", "0.0", "123456789012345678.0", "0.0001", "1e-4", "9999999999999998.0",
              "1.25e300", "12345678901234567890", "-7", "1e2", "0.1", "3.0e5", "10000000.0", "0.30000000000000004"]
    texts = ['{"properties":{"x":{"type":"a","enum":[%s]}}}' % v for v in values]
    want = [f"- x (a, optional) enum[{json.loads(v)}]" for v in values]
    assert render(spark, texts) == want


def test_repeated_keys_in_one_specification(spark):
    text = '{"properties":{"x":{"type":"a","enum":[1],"type":"b","enum":[2]},"y":{"type":"c"}}}'
    df = R.with_params_text(rows(spark, [text]))
    assert df.first().params_text == "- x (b, optional) enum[2]\n- y (c, optional)"
    assert [r.line for r in R.params_table(rows(spark, [text])).orderBy("position").collect()] == df.first().params_text.split("\n")
