import json

from gazette import config as C
from gazette.operators.summarize import json_span, parse_responses


def parsed(spark, responses):
    df = spark.createDataFrame(list(enumerate(responses)), "article_id int, response string")
    return {r.article_id: r for r in parse_responses(df).collect()}


def test_response_cases(spark):
    good = {"short_summary": "S", "detailed_summary": "D", "key_insights": ["i1", "i2"], "tags": ["a", "b"]}
    seven = dict(good, tags=[f"t{i}" for i in range(7)])
    long_short = dict(good, short_summary="x" * 600)
    cases = [json.dumps(good), "Sure! Here it is:\n" + json.dumps(good) + "\nThanks.", json.dumps({"tags": ["only"]}),
             json.dumps(dict(good, key_insights=None)), json.dumps(seven), json.dumps(long_short),
             "{'short_summary': 'single'}", "no braces at all", "{broken json", '{"a": 1'] 
    r = parsed(spark, cases)
    assert r[0].parsed and r[0].short_summary == "S" and r[0].key_insights == ["i1", "i2"] and r[0].tags == ["a", "b"]
    assert r[1].parsed and r[1].detailed_summary == "D"
    assert r[2].parsed and (r[2].short_summary, r[2].detailed_summary, r[2].key_insights) == ("", "", []) and r[2].tags == ["only"]
    assert r[3].parsed and r[3].key_insights == []          # JSON null list → empty (L9 fix)
    assert r[4].tags == ["t0", "t1", "t2", "t3", "t4"]
    assert len(r[5].short_summary) == C.SHORT_SUMMARY_CHARS
    for i in (6, 7, 8, 9):                                   # single quotes, no braces, broken
        assert not r[i].parsed
        assert r[i].short_summary == C.FALLBACK_SHORT_SUMMARY
        assert r[i].detailed_summary == cases[i][:500]
        assert r[i].key_insights == [C.FALLBACK_INSIGHT] and r[i].tags == list(C.FALLBACK_TAGS)


def test_text_behind_the_object_takes_the_fallback(spark):
    good = json.dumps({"short_summary": "S", "tags": ["a"]})
    cases = [good, good + " then " + good, good + ", " + good, good + "]" + good, good + "} , {" + good, good + "}", "note: " + good + "\nbye",
             " \n" + good + "\n", '{"short_summary": "a } b { c"}']
    r = parsed(spark, cases)
    assert [r[i].parsed for i in range(len(cases))] == [True, False, False, False, False, False, True, True, True]
    df = spark.createDataFrame(list(enumerate(cases)), "article_id int, response string")
    strict = {x.article_id: x.parsed for x in parse_responses(df, strict=True).collect()}
    assert [strict[i] for i in range(len(cases))] == [True, False, False, False, False, False, False, True, True]


def test_json_span(spark):
    df = spark.createDataFrame([("a {x} b {y} c",), ("}{",), ("none",)], "response string")
    assert [r[0] for r in df.select(json_span("response")).collect()] == ["{x} b {y}", None, None]
