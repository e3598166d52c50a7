import pytest

from tidemark.llm import decontaminate

ITEM = ("A train leaves London at 9 with 120 people and a load of 30 kg per person. After 2 hours Maria Lopez "
        "counts the 120 people again while the train moves on to the coast.")
CHANGED = ("A train leaves Paris at 7 with 85 people and a load of 44 kg per person. After 5 hours Tom "
           "counts the 85 people again while the train moves on to the coast.")
TORN = CHANGED.replace("the 85 people again", "the 99 people again")
OTHER = "Nothing here has much to do with trains, people or loads, but it is long enough to give a few windows of words."


@pytest.fixture
def bench(spark):
    rows = [(1, ITEM), (2, "Only five words stand here"), (3, None), (4, ""), (None, "... --- ..."), (5, ITEM)]
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, h string")


def judged(docs, bench):
    return {(r.doc_id, tuple(r.item_ids)) for r in decontaminate.judge(docs, bench).collect()}


ROWS = [(1, "Before that. " + ITEM + " After that."), (2, CHANGED), (3, TORN), (4, OTHER), (5, None), (6, ""),
        (7, "x, only five words stand here, y"), (None, ITEM.upper()), (8, "filler words " * 40_000 + ITEM), (8, ITEM.lower()),
        (9, " ".join(ITEM.split()[:9]))]
WANT = {(1, (1, 5)), (2, (1, 5)), (3, ()), (4, ()), (5, ()), (6, ()), (7, (2,)), (8, (1, 5)), (9, ())}


@pytest.mark.parametrize("shipped", [1_000_000, 0])
def test_finds_items_with_other_values_and_leaves_the_rest(spark, docs_of, bench, monkeypatch, shipped):
    monkeypatch.setattr(decontaminate, "SHIPPED", shipped)       # 0: no filter is sent, all windows are joined
    got = judged(docs_of(ROWS, clash=True), bench)
    assert {g for g in got if g[0] is not None} - {(8, ())} == WANT


def test_clean_drops_only_what_was_found(spark, docs_of, bench):
    docs = docs_of(ROWS[:7], clash=True)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_empty_tables(spark, docs_of, bench):
    assert judged(docs_of([]), bench) == set()
    assert judged(docs_of([(1, ITEM)]), bench.limit(0)) == {(1, ())}


def test_placeholders():
    own = decontaminate.Templates()
    text = "On Monday Ann Lee paid 3.50 for 12kg.\nThe two men ran 7 miles, USA won."
    _, kind, ids, bounds, of = own.read([text, "a \x02 b", None, text])
    one = kind[of == 0]
    assert own.slots(kind, ids, bounds, 0, len(one)) == ["monday ann lee", "3.50", "12kg", "two", "7", "miles"]
    assert one.tolist().count(decontaminate.NUMBER) == 4 and one.tolist().count(decontaminate.UNIT) == 1
    assert one.tolist() == kind[of == 3].tolist() and (of == 1).sum() == 2 and (of == 2).sum() == 0


MIDDLE = ITEM.replace("After 2 hours", "After {} 2 hours")
SPACED = ITEM.replace("After 2", "Nobody had thought of the weather in that season. After 2")
LONGER = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59))


@pytest.mark.parametrize("text, want", [
    (MIDDLE.format("about"), (1, 5)),                                           # one word put in
    (ITEM.replace("After 2", "2"), (1, 5)),                                     # one left out
    (ITEM.replace("After", "Within"), (1, 5)),                                  # one replaced
    (CHANGED.replace("After", "After about"), (1, 5)),
    (TORN.replace("After", "After about"), ()),                                 # each half holds 10 windows, the values differ
    (SPACED, (1, 5)),
    (" ".join(ITEM.split()[18:] + ITEM.split()[:18]), ()),                      # the halves swapped
    (" ".join(ITEM.split()[:17]) + " stop " + "filler words " * 400 + " ".join(ITEM.split()[17:]), ()),             # no half near the other
])
def test_windows_on_both_sides_of_a_change_add_up(spark, docs_of, bench, text, want):
    assert judged(docs_of([(1, "Before that. " + text + " After that.")]), bench) == {(1, want)}


def test_long_excerpts_count_by_themselves(spark, docs_of):
    bench = spark.createDataFrame([(1, LONGER)], "item_id bigint, text string")
    words = LONGER.split()
    rows = [(n, "so it says " + " ".join(words[20:20 + n]) + " and no more") for n in (30, 20, 19)]
    assert judged(docs_of(rows), bench) == {(30, (1,)), (20, (1,)), (19, ())}


TOM = "Tom has 5 apples. Tom buys 3 more. How many does Tom have?"


@pytest.mark.parametrize("item, text, found", [
    (ITEM, ITEM.lower(), True),
    (ITEM, ITEM.upper(), True),
    (TOM, TOM.replace("Tom", "Ann").replace("5", "7").replace("3", "4"), True),
    (TOM, "Ann has 7 apples. Bob buys 4 more. How many does Ann have?", False),          # one name became two
    ("Tom has 5 apples and eats 2.", "Ann has 7 apples and eats 3.", True),              # the name only opens
    ("Then old McDonald and TOM had 5 farms in all", "Then old O'Brien and ANN had 7 farms in all", True),
    ("What is the capital of France?", "Paris is the capital of France.", False),
])
def test_names_are_told_where_a_sentence_opens_and_copies_match_in_any_case(spark, docs_of, item, text, found):
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert judged(docs_of([(1, "Before that. " + text + " After that.")]), bench) == {(1, (1,) if found else ())}


def test_exact_copies_in_other_case_among_other_rows(spark, docs_of, bench):
    got = judged(docs_of([(1, ITEM.lower()), (2, OTHER.upper()), (None, ITEM.upper())]), bench)
    assert got == {(1, (1, 5)), (2, ()), (None, (1, 5))}


@pytest.mark.parametrize("number", ["7", "twenty five", "twenty-five", "two hundred and five", "one", "5 million", "Three thousand six"])
@pytest.mark.parametrize("unit", ["{} kg of", "{}-kg of", "{} pounds of"])
def test_numbers_and_units_have_one_form(number, unit):
    own = decontaminate.Templates()
    codes = [next(own.views([f"then they bought {u} flour, and left"]))[0].tolist() for u in ("9 kg of", unit.format(number))]
    assert codes[0] == codes[1]


def test_glued_units_and_numbers_that_stay_apart():
    own = decontaminate.Templates()

    def read(text):
        code, _, slots = next(own.views([text, "next 3kg"]))
        return slots(0, len(code))

    assert read("load 12kg or 5%, ten-mile") == ["12", "kg", "5", "%", "ten", "mile", "3", "kg"]
    assert read("one, two. Three\nfour") == ["one", "two", "three", "four", "3", "kg"]
    assert read("between one hundred and two hundred") == ["one hundred", "two hundred", "3", "kg"]
    assert read("one hundred and five kg") == ["one hundred and five", "kg", "3", "kg"]


def test_finds_items_with_numbers_and_units_written_in_other_ways(spark, docs_of, bench):
    text = ("A train leaves Paris at 7 with eighty-five people and a load of 44kg per person. After twenty five hours Tom "
            "counts the eighty-five people again while the train moves on to the coast.")
    assert judged(docs_of([(1, text), (2, text.replace("the eighty-five", "the ninety"))]), bench) == {(1, (1, 5)), (2, ())}
