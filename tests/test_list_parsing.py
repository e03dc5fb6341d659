"""How often a small list file is parsed."""

from runatlas.sources import json_lists
from runatlas.sources.json_records import read_json_list


def test_a_small_file_is_parsed_once_to_see_and_once_to_take(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", ' [{"experiment_id": "x"}, null, 3]'), ("c", "[ \n]"), ("d", "")):
        (tmp_path / f"{name}.json").write_text(text)
    found = json_lists.list_elements(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 2
    rows = sorted((r.pos, r.v.toJson()) for r in found.collect())
    assert rows == [(0, '{"experiment_id":"x"}'), (1, "null"), (2, "3")]
    assert sorted(r._row for r in read_json_list(spark, str(tmp_path)).collect()) == [0, 1, 2]
