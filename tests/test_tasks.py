import datetime as dt

import pytest

from sessionscope.sources.tasks import TaskParams, load_task, task_ids_from_text


def tasks(spark, *rows):
    return spark.createDataFrame(list(rows), "task_id long, task_param string")


def test_parse_full_task(spark):
    t = tasks(spark, (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["20"],'
                         '"endAge":["45"],"cities":["c1,c2"],"sex":["male"],"keywords":["a,b"],'
                         '"categoryIds":["1,2"],"targetPageFlow":["1,2,3"],"professionals":[""]}'))
    p = load_task(t, 1)
    assert p == TaskParams(start_date=dt.date(2024, 1, 1), end_date=dt.date(2024, 1, 31), start_age=20,
                           end_age=45, cities=("c1", "c2"), sex="male", keywords=("a", "b"),
                           category_ids=(1, 2), target_page_flow=(1, 2, 3), task_id=1)
    assert p.professionals is None          # an empty value counts as absent


@pytest.mark.parametrize("param, message", [
    ('{"endDate":["2024-01-31"]}', "startDate"),
    ('{"startDate":["2024-01-01"],"endDate":"2024-01-31"}', "JSON object of arrays"),
    ('{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["x"]}', "startAge"),
    ('{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"cities":["a","b"]}', "more than one"),
    ('{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"categoryIds":["1,x"]}', "categoryIds"),
])
def test_invalid_tasks_raise(spark, param, message):
    with pytest.raises(ValueError, match=message):
        load_task(tasks(spark, (1, param)), 1)


def test_unknown_task_raises(spark):
    with pytest.raises(ValueError, match="no task"):
        load_task(tasks(spark, (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}')), 2)


def test_first_row_wins_for_a_repeated_id(spark):
    t = tasks(spark, (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}'))
    assert load_task(t, 1).end_date == dt.date(2024, 1, 31)


def test_task_ids_from_text():
    assert task_ids_from_text("42") == [42]
    assert task_ids_from_text(" 3,1, 3,") == [3, 1]
    for bad in ("", ",", "x", "1,x"):
        with pytest.raises(ValueError):
            task_ids_from_text(bad)

def test_numbers_and_empty_arrays(spark):
    t = tasks(spark, (1, '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":[20],"endAge":[30],'
                         '"categoryIds":[5],"cities":[]}'))
    p = load_task(t, 1)
    assert (p.start_age, p.end_age, p.category_ids, p.cities) == (20, 30, (5,), None)
