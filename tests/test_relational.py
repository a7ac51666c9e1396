import random

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from trackmill.operators import quality, relational
from trackmill.plans import employees, sales
from trackmill.plans import lines as line_plans
from trackmill.sinks.writers import report_line, rows_not_yet_in
from trackmill.sources.files import read_employees_json, read_sales, read_sales_text


def sales_rows():
    """The sample's rows in plain Python, and those that the cleaning keeps."""
    fields = [line.split("\t") for line in (DATA / "sales.tsv").read_text().splitlines()]
    made = [(int(f[0]), f[1], f[2], *map(int, f[3:])) for f in fields]
    clean = [r for r in made if r[3] * 3 + r[7] != 0 and abs(sum(r[4:7]) - 3 * r[3]) < 3]
    return made, clean


def totals(of, place):
    sums = {}
    for r in of:
        sums[r[place]] = sums.get(r[place], 0) + sum(r[4:7])
    return sorted(sums.items(), key=lambda x: (-x[1], x[0]))


def test_sales_golden(spark):
    raw, (made, kept) = read_sales(spark, str(DATA / "sales.tsv")), sales_rows()
    clean = sales.clean(raw)
    assert rows(raw) == sorted(made) and rows(clean) == sorted(kept) and 0 < len(kept) < len(made)
    assert sales.product_count(clean).first()[0] == len({r[1] for r in kept})
    for key, place in (("product", 1), ("region", 2)):
        best = [tuple(r) for r in sales.best_sellers(clean, key, 2).orderBy("place").collect()]
        assert best == [(*r, n) for n, r in enumerate(totals(kept, place)[:2], 1)]
        assert rows(sales.totals_by(clean, key)) == sorted(totals(kept, place))
    growth = []
    for region in {r[2] for r in made}:
        now, before = (sum(f(r) for r in made if r[2] == region) for f in (lambda r: 4 * r[3], lambda r: r[8]))
        if before >= sales.LEAST_LAST_YEAR:
            growth.append((region, now - before, before, (now - before) / before))
    assert rows(sales.growth_by_region(raw)) == sorted(growth)
    assert [tuple(r) for r in sales.fastest_growing_region(raw).collect()] == [max(growth, key=lambda g: g[3])]
    line = sales.report(clean.orderBy("code").limit(1), clean.columns).first()[0]
    assert line == ",".join(map(str, sorted(kept)[0]))


def test_sales_text_equals_sales(spark):
    numbers = sales.numbers_from_text(read_sales_text(spark, str(DATA / "sales_text.tsv")))
    assert rows(numbers) == sorted(sales_rows()[0])


def test_employee_queries(spark):
    df = read_employees_json(spark, str(DATA / "employees.json"))
    assert employees.all_rows(df).count() == 8
    assert employees.one_per_id(df).count() == 6
    assert employees.without_id(df).columns == ["name", "age"]
    assert [r.age for r in employees.older_than(df, 40).collect()] == [41]
    assert set(rows(employees.count_by_age(df))) == {(41, 1), (33, 4), (27, 1), (None, 2)}
    assert [r.name for r in employees.by_name(df).collect()] == [" Vera", "Ada", "Hugo", "Mila", "Mila", "Mila", "Otto", "Otto"]
    assert [r.id for r in employees.first_rows(df).collect()] == [1, 2, 2]
    assert employees.user_names(df).columns == ["username"]
    assert employees.mean_age(df).first()[0] == 200 / 6 and employees.least_age(df).first()[0] == 27
    assert employees.query_view(df, "employee", "select count(*) n from employee").first().n == 8
    assert employees.report(df.filter("id = 4")).first().line == "id:4,name:Hugo,age:27"


def test_smoke_queries(spark):
    assert line_plans.hello(spark).first().hello == "spark"
    assert line_plans.sum_of_ids(spark).first().total == 45


def test_lines(spark):
    lines = spark.createDataFrame([(v,) for v in ["ab", "b", "", "xyz", "a a"]], "value string")
    assert tuple(line_plans.lines_with_a_and_b(lines).first()) == (2, 2)
    values = ["1,2,30,4", "1,2,5,4", " ", "1,2,3", "1,2,99,4,5", "1,2,x,4", "1,2,-7,4", "1,2,8,4", "1,2,8,9", "0,0,6,0"]
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.number for r in line_plans.largest_numbers(lines).collect()] == [30, 8, 8, 6, 5]


def test_keep_first_and_its_plan(spark):
    data = [(k, i, f"v{i}") for i, k in enumerate(["a", "a", "b", None, None, "a"])]
    df = spark.createDataFrame(data, "k string, i int, v string")
    first = relational.keep_first(df, ["k"], ["i"])
    assert set(rows(first)) == {("a", 0, "v0"), ("b", 2, "v2"), (None, 3, "v3")}
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 7, 20, 30])
def test_after_first_n(spark, n):
    data = [(i % 5, i) for i in range(20)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "a int, b int")
    rest = relational.after_first_n(df, n, ["a", "b"])
    assert rows(rest) == sorted(data)[n:]
    assert rows(relational.stack(rest, relational.first_n(df, n, ["a", "b"]))) == sorted(data)


def test_growth_skips_small_and_zero(spark):
    data = [("a", 10, 5), ("a", 10, 15), ("b", 1, 0), ("c", 9, 3)]
    df = spark.createDataFrame(data, "k string, now int, last int")
    growth = relational.growth_by(df, ["k"], F.col("now"), F.col("last"))
    assert set(rows(growth)) == {("a", 0, 20, 0.0), ("b", 1, 0, None), ("c", 6, 3, 2.0)}
    assert relational.fastest_growth(growth.filter("growth is not null"), ["k"]).first().k == "c"
    assert relational.growth_by(df, ["k"], F.col("now"), F.col("last"), 4).count() == 1


def test_hash_split_is_stable(spark):
    df = spark.range(2000)
    train, test = relational.hash_split(df, "id", 0.7)
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert 1300 < train.count() < 1500
    again, _ = relational.hash_split(df.repartition(7), "id", 0.7)
    assert rows(again) == rows(train)
    parts = relational.random_split(df, [0.7, 0.3], seed=1)
    assert sum(p.count() for p in parts) == 2000
    nulls = spark.createDataFrame([(None,), ("x",)], "k string")
    assert sum(p.count() for p in relational.hash_split(nulls, "k", 0.5)) == 2


def test_ranked_and_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", 2)], "k string, v int")
    assert [tuple(r) for r in relational.ranked(df, 3, "v", ["k"]).orderBy("place").collect()] == [
        ("b", 3, 1), ("c", 3, 2), ("d", 2, 3),
    ]


def test_fill_lookup_append(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert rows(relational.fill_zero(df, "v")) == [(1, 0), (2, 5)]
    codes = spark.createDataFrame([(1, "one")], "k int, name string")
    assert set(rows(relational.lookup(df, codes, "k"))) == {(1, None, "one"), (2, 5, None)}
    assert rows(rows_not_yet_in(df, codes, ["k"])) == [(2, 5)]
    assert df.filter("k = 2").select(report_line("k:%d,v:%d", "k", "v")).first()[0] == "k:2,v:5"


def test_quality(spark):
    df = spark.createDataFrame([("1", "x"), ("z", "x"), (None, "y"), ("3", None)], "n string, d string")
    assert quality.incomplete_rows(df).count() == 2 and quality.complete_rows(df).count() == 2
    rules = {"n": F.col("n").try_cast("int").isNotNull(), "d": quality.in_domain(F.col("d"), ["x"])}
    found = {(r.n, r.d): r.violations for r in quality.with_violations(df, rules).collect()}
    assert found == {("1", "x"): [], ("z", "x"): ["n"], (None, "y"): ["n", "d"], ("3", None): ["d"]}
    assert quality.invalid_rows(df, rules).count() == 3 and rows(quality.valid_rows(df, rules)) == [("1", "x")]
