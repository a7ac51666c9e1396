import random

import pytest

from trackmill.functions.categories import CENSUS_CATEGORIES
from trackmill.operators import relational, trees
from trackmill.plans import census
from trackmill.schemas import CENSUS, CENSUS_ATTRIBUTES, CENSUS_NUMBERS
from trackmill.sources.files import read_census, read_iris


def person(rng):
    """A made-up census row whose label follows from age and sex."""
    values = []
    for name in CENSUS_ATTRIBUTES:
        values.append(str(rng.randint(17, 90)) if name in CENSUS_NUMBERS else rng.choice([*CENSUS_CATEGORIES[name], "?"]))
    rich = int(values[0]) > 50 and values[CENSUS_ATTRIBUTES.index("sex")] == "Male"
    return [*values, ">50K" if rich else "<=50K"]


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    rng, folder = random.Random(2), tmp_path_factory.mktemp("census")
    for name, n in (("train", 600), ("test", 200)):
        dot = "." if name == "test" else ""
        lines = [", ".join(person(rng)) + dot for _ in range(n)]
        (folder / name).write_text("\n".join((["|remark"] if dot else []) + lines) + "\n")
    return [read_census(spark, str(folder / "train")), read_census(spark, str(folder / "test"), comment="|")]


def test_census_tree(people):
    train, test = people
    assert (train.count(), test.count()) == (600, 200)
    assert census.faulty_rows(train).count() == 0
    model = census.fit(train)
    predicted = trees.predict(model, census.features(test))
    assert set(predicted.select("label").distinct().toPandas().label) == {">50K", "<=50K"}
    scores = trees.scores(predicted)
    assert scores["accuracy"] > 0.95 and scores["f1"] > 0.95
    assert predicted.filter("label = predicted_label").count() == round(scores["accuracy"] * 200)
    assert "If (feature" in trees.tree_text(model)


def test_faulty_rows(spark):
    good = person(random.Random(1))
    faults = {
        "age": "x", "workclass": "Pirate", "fnlwgt": "", "native_country": None, "sex": "male",
    }
    made = [good]
    for name, value in faults.items():
        row = list(good)
        row[CENSUS_ATTRIBUTES.index(name)] = value
        made.append(row)
    df = spark.createDataFrame(made, CENSUS)
    found = census.faulty_rows(df).collect()
    assert sorted(v for r in found for v in r.violations) == sorted(faults)
    encoded = census.encoded(df)
    assert encoded.filter(" or ".join(f"{c} is null" for c in CENSUS_ATTRIBUTES)).count() == len(faults)


def test_faulty_lines(spark, tmp_path):
    lines = [person(random.Random(i)) for i in range(30)]
    lines[3][0], lines[17][1] = "x", "Pirate"
    (tmp_path / "census").write_text("".join(", ".join(line) + "\n" for line in lines) + "short\n")
    found = census.faulty_lines(spark, str(tmp_path / "census")).orderBy("line_no").collect()
    assert [(r.line_no, r.violations) for r in found[:2]] == [(4, ["age"]), (18, ["workclass"])]
    assert found[2].line_no == 31 and len(found[2].violations) == 14


def test_iris_tree(spark, tmp_path):
    rng = random.Random(4)
    kinds = {"setosa": 1.4, "versicolor": 4.3, "virginica": 5.6}
    lines = [
        f"{rng.gauss(5.8, 0.5):.1f},{rng.gauss(3, 0.3):.1f},{rng.gauss(mid, 0.2):.1f},{rng.gauss(mid / 3, 0.1):.1f},{kind}"
        for kind, mid in kinds.items() for _ in range(50)
    ]
    (tmp_path / "iris").write_text("\n".join(lines))
    data = census.iris_features(read_iris(spark, str(tmp_path / "iris")))
    train, test = relational.random_split(data, [0.7, 0.3], seed=3)
    scores = trees.scores(trees.predict(trees.tree_pipeline(train), test))
    assert scores["f1"] > 0.9 and scores["accuracy"] > 0.9


def test_unseen_category(spark):
    rows = [(float(i % 3), float(i), "ab"[i % 2]) for i in range(40)]
    train = trees.assemble(spark.createDataFrame(rows, "c double, n double, label string"), ["c", "n"])
    test = trees.assemble(spark.createDataFrame([(9.0, 1.0, "a")], "c double, n double, label string"), ["c", "n"])
    assert trees.predict(trees.tree_pipeline(train, unseen="keep"), test).count() == 1
    with pytest.raises(Exception):
        trees.predict(trees.tree_pipeline(train), test).collect()
