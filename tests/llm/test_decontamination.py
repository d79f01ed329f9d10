import random
import re

import pytest

from sessionscope.llm import decontamination as dc
from sessionscope.llm.queries import op2_decontamination

from .conftest import SF001, SF01


def test_query_finds_exactly_the_documents_with_passages(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()}
    want = {d: sorted(i for i, t in items.items() if t in text) for d, text in docs.items()}
    got = {r.doc_id: r for r in op2_decontamination(spark, SF01).collect()}
    assert len(got) == len(docs) and any(want.values())
    assert {d: r.item_ids for d, r in got.items()} == want
    assert all(r.contaminated == bool(r.item_ids) for r in got.values())


ITEM = ("Alice buys 12 apples for 3 dollars each at the market. Then she gives 5 of them to Robert and walks 2 km home. "
        "How many apples does Alice have left when she meets Robert again?")


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(spark, documents, texts, items=None, **options):
    rows = dc.find(documents(list(enumerate(texts))), benchmark(spark, items or [(7, ITEM)]), **options).collect()
    return [r.contaminated for r in sorted(rows, key=lambda r: r.doc_id)]


def filler(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_copies_and_other_values(spark, documents):
    other = ITEM.replace("Alice", "Maria").replace("Robert", "Ivan").replace("12", "1,450").replace("5", "9") \
        .replace("km", "miles").replace("3 dollars", "7 euros")
    half = ITEM.split("How many")[0]
    texts = [ITEM, f"{filler(1)} {ITEM} {filler(2)}", other, f"{filler(3)}. {other}", ITEM.lower(), ITEM.upper(),
             f"{filler(4)} {half} {filler(5)}", filler(6), "", None, " ".join(reversed(ITEM.split())),
             "Alice buys 12 apples", "the market. Then she gives"]
    assert found(spark, documents, texts) == [True, True, True, True, True, True, True, False, False, False, False,
                                              False, False]


def test_other_values_must_correspond(spark, documents):
    form = "{} paid {} to {}, then {} gave back {} and {} paid {} again while {} kept {} for {}."
    item = form.format("Alice", 5, "Robert", "Robert", 5, "Alice", 5, "Robert", 5, "Alice")
    same = form.format("Omar", 8, "Zoe", "Zoe", 8, "Omar", 8, "Zoe", 8, "Omar")
    mixed = form.format("Omar", 8, "Zoe", "Kim", 9, "Pete", 3, "Lena", 4, "Ivan")
    assert found(spark, documents, [item, same, mixed], [(1, item)]) == [True, True, False]


def test_slots_must_correspond():
    import numpy as np
    a = np.array([1, 2, 1, 3])
    assert dc._consistent(a, a + 10) == 1
    assert dc._consistent(a, np.array([11, 12, 14, 13])) == .75
    assert dc._consistent(a, np.array([9, 9, 9, 9])) == .5
    assert dc._consistent(a[:0], a[:0]) == 1


def test_parts_of_the_benchmark_give_the_same(spark, documents):
    items = [(i, filler(i, 20 + i)) for i in range(30)] + [(3, filler(3, 23)), (None, filler(99)), (50, None), (51, ""),
                                                          (52, "a b"), (53, "five short words are here")]
    texts = [f"{filler(i + 200)} {filler(i % 30, 20 + i % 30)} {filler(i + 5, 25 + i) if i < 25 else ''}" for i in range(40)]
    texts += [filler(99), "x five short words are here y", "a b"]
    docs = documents(list(enumerate(texts)), "'x' as coverage")
    whole = dc.find(docs, benchmark(spark, items))
    assert whole.columns == ["doc_id", "text", "lang", "source", "n_chars", *dc.ADDED]
    want = {r.doc_id: (r.contaminated, r.item_ids, r.text) for r in whole.collect()}
    assert want[40][:2] == (True, []) and want[41][:2] == (True, [53]) and want[42][:2] == (False, [])
    assert all(i % 30 in want[i][1] for i in range(40))
    parts = dc.find(docs, benchmark(spark, items), keep=["doc_id"], max_windows=2000)
    assert parts.columns == ["doc_id", *dc.ADDED]
    assert {r.doc_id: (r.contaminated, r.item_ids) for r in parts.collect()} == {d: w[:2] for d, w in want.items()}


def test_empty_tables_long_texts_and_repeats(spark, documents):
    assert dc.find(documents([]), benchmark(spark, [(1, ITEM)])).count() == 0
    assert [r.contaminated for r in dc.find(documents([(1, ITEM)]), benchmark(spark, [])).collect()] == [False]
    long = f"{filler(8, 200000)} {ITEM} {filler(9, 200000)}"
    docs = documents([(1, long), (2, ITEM), (2, ITEM), (None, ITEM), (5, "1 2 3 " * 9000), (6, "A B C " * 9000)])
    got = dc.find(docs, benchmark(spark, [(1, ITEM), (2, "1 2 3 " * 10), (3, "A B C " * 10)])).collect()
    assert sorted((str(r.doc_id), r.item_ids) for r in got) == [
        ("1", [1]), ("2", [1]), ("2", [1]), ("5", [2]), ("6", [3]), ("None", [1])]


@pytest.mark.parametrize("text,types", [
    ("Paris has 1,200.5 km, ok", [dc.NAME, dc.LITERAL, dc.NUMBER, dc.UNIT, dc.LITERAL]),
    ("École élan ten pounds", [dc.NAME, dc.LITERAL, dc.NUMBER, dc.UNIT]), ("pounds. 3.", [dc.LITERAL, dc.NUMBER])])
def test_types_of_tokens(text, types):
    assert dc._Tokens([text.encode()]).type.tolist() == types


@pytest.mark.parametrize("item,other,differs", [
    ("What is 12 + 7 * 3?", "What is 45 + 8 * 6?", "What was 45 + 8 * 6?"),
    ("What is 12?", "What is 45?", "What was 45?"),
    ("Solve 3 x + 4 y = 12", "Solve 5 x + 7 y = 31", "Solve 5 x + 7 z = 31"),
    ("Add 12 kg 5 g and 7 kg 250 g", "Add 31 miles 8 feet and 6 miles 90 feet", "Add 31 miles 8 feet or 6 miles 90 feet"),
    ("Anna Berg met Carl Dorn and Emil Falk saw 7 Gulls 8 Hens 9 Ibis", "Ruth Senn met Theo Uhl and Vera Wolf saw 1 Xerus 4 "
     "Yaks 6 Zebras", "Ruth Senn met Theo Uhl and Vera Wolf saw 1 Xerus 4 Yaks 6")])
def test_items_dense_in_slots_with_other_values(spark, documents, item, other, differs):
    texts = [item, other, f"{filler(1)} {other}, {filler(2)}", differs, f"{filler(3)} {differs} {filler(4)}", filler(5)]
    assert found(spark, documents, texts, [(1, item)]) == [True, True, True, False, False, False]


def test_dense_items_keep_the_order_of_types(spark, documents):
    item = "Add 12 kg 5 g and 7 kg 250 g"
    assert found(spark, documents, ["Add kg 12 5 g and 7 kg 250 g", "Add 12 kg 5 g and 7 kg"], [(1, item)]) == [False, True]
    assert found(spark, documents, ["Add 1 kg 2 g and 3 kg", "Add 1 kg 1 kg and 1 kg 1 kg"], [(1, item)]) == [False, False]


def test_columns_named_like_the_added_ones_are_never_read(spark, documents):
    docs = documents([(1, filler(1)), (2, ITEM)]).selectExpr(
        "*", "true as contaminated", "array(99L) as item_ids", "cast(null as double) as coverage",
        "cast(null as double) as consistency", "1 as `a.b`", "2 as `key`", "3 as `ids`")
    for windows in (dc.MAX_WINDOWS, 10):
        got = {r.doc_id: r for r in dc.find(docs, benchmark(spark, [(7, ITEM), (8, ITEM)]), max_windows=windows).collect()}
        assert (got[1].contaminated, got[1].item_ids, got[1].coverage) == (False, [], 0.0)
        assert (got[2].contaminated, got[2].item_ids, got[2].coverage) == (True, [7, 8], 1.0)
        assert got[1]["a.b"] == 1 and got[1]["key"] == 2 and got[1]["ids"] == 3


CHINESE = "\u5c0f\u660e\u4e70\u4e8612\u4e2a\u82f9\u679c\uff0c\u6bcf\u4e2a3\u5143\u3002\u4ed6\u4e00\u5171\u82b1\u4e86\u591a\u5c11\u94b1\uff1f"
RUSSIAN = "\u0412\u0447\u0435\u0440\u0430 \u0410\u043d\u043d\u0430 \u043a\u0443\u043f\u0438\u043b\u0430 5 \u043a\u043d\u0438\u0433 \u0438 \u043f\u043e\u0434\u0430\u0440\u0438\u043b\u0430 \u043e\u0434\u043d\u0443 \u0418\u0432\u0430\u043d\u0443 \u0432 \u041c\u043e\u0441\u043a\u0432\u0435"


def test_scripts_and_punctuation(spark, documents):
    quoted = "She didn't say 'no' - she said \"maybe later\" to all of us at home"
    curly = "She didn\u2019t say \u2018no\u2019 \u2013 she said \u201cmaybe\u00a0later\u201d to\u00a0all of us at home"
    other = RUSSIAN.replace("\u0410\u043d\u043d\u0430", "\u041e\u043b\u044c\u0433\u0430").replace("5", "9") \
        .replace("\u0418\u0432\u0430\u043d\u0443", "\u041f\u0435\u0442\u0440\u0443").replace("\u041c\u043e\u0441\u043a\u0432\u0435", "\u041e\u043c\u0441\u043a\u0435")
    items = [(1, CHINESE), (2, RUSSIAN), (3, quoted)]
    texts = [f"{filler(1)} {CHINESE} {filler(2)}", CHINESE.replace("12", "45"), RUSSIAN.upper(), other, curly,
             "\u4ed6\u82b1\u94b1" * 30, filler(3)]
    rows = dc.find(documents(list(enumerate(texts))), benchmark(spark, items)).collect()
    assert [r.item_ids for r in sorted(rows, key=lambda r: r.doc_id)] == [[1], [1], [2], [2], [3], [], []]


@pytest.mark.parametrize("item,clean", [
    ("What is 12?", "Anna is 30 and likes tea."), ("Who wrote Hamlet?", "Anna wrote Letters every day of her life"),
    ("What is 12 + 7 * 3", "It is 5, 6, 7"), ("Where does Tom live?", "There does Ann live? Maybe.")])
def test_the_first_word_of_a_sentence_is_no_name(spark, documents, item, clean):
    assert found(spark, documents, [item, clean, f"{filler(1)}. {clean}"], [(1, item)]) == [True, False, False]


def test_short_items_leave_clean_documents_alone(spark):
    """None of the clean documents holds one of many short questions."""
    items = [(i, t) for i, t in enumerate(["What is 12?", "Who wrote Hamlet?", "How many days are in 3 weeks?",
                                           "What is 12 + 7 * 3", "When did Rome fall?", "Is 7 a prime number?"])]
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert dc.find(docs, benchmark(spark, items)).where("contaminated").count() == 0


def naive(texts, items):
    """Template and plain runs by their definition, item by item and place by place."""
    def tokens(t):
        found = [(m.group(), m.start()) for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", t)]
        out = []
        for k, (w, at) in enumerate(found):
            number = w[0].isdigit() or w.lower() in dc.NUMBER_WORDS
            unit = not number and out and out[-1][1] == dc.NUMBER and w.lower() in dc.UNITS
            kind = dc.NUMBER if number else dc.UNIT if unit else dc.NAME if w[0] != w[0].lower() else dc.LITERAL
            before = t[found[k - 1][1] + len(found[k - 1][0]):at] if k else "."
            out.append((w.lower(), kind, bool(set(before) & set(".!?:;\n\u2026"))))
        return out

    def holds(doc, item):
        inner = {w for w, k, b in item if k == dc.NAME and not b}
        firm = [k == dc.NAME and b and w not in inner and not (i + 1 < len(item) and item[i + 1][1] == dc.NAME
                                                              and not item[i + 1][2]) for i, (w, k, b) in enumerate(item)]
        size = len(item)
        code = lambda x: x[0] if x[1] == dc.LITERAL else x[1]
        for shift in range(-size + 1, len(doc)):
            lo, hi = max(0, -shift), min(size, len(doc) - shift)
            same = [code(doc[shift + i]) == code(item[i]) and not (firm[i] and doc[shift + i][0] != item[i][0])
                    for i in range(lo, hi)]
            run = 0
            for i in [*range(lo, hi), None]:
                if i is not None and same[i - lo]:
                    run += 1
                    continue
                if run >= 13 or run >= size / 2 and run >= 8:
                    return True
                run = 0
        return False

    listed = {i: tokens(t) for i, t in items.items()}
    return {d: sorted(i for i, item in listed.items() if len(item) >= 8 and holds(tokens(t or ""), item))
            for d, t in texts.items()}


def test_query_against_brute_force_of_templates(spark):
    """Everything that the naive comparison of templates finds, and nothing else."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    got = {r.doc_id: r.item_ids for r in op2_decontamination(spark, SF001).collect()}
    shorter = {d: t for d, t in texts.items() if t is None or len(t) < 4000}
    want = naive(shorter, items)
    assert any(want.values())
    for d, ids in want.items():
        long = [i for i in got[d] if len(re.findall(r"\w+", items[i])) >= 8]
        assert long == ids, d
