"""Fixed schemas of the inputs."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _fields(kind, *names):
    return [StructField(name, kind) for name in names]


_SALES_NUMBERS = ("avg3", "w1", "w2", "w3", "forecast", "last_year")

SALES = StructType(
    _fields(IntegerType(), "code")
    + _fields(StringType(), "product", "region")
    + _fields(IntegerType(), *_SALES_NUMBERS)
)
# The same table while its numbers are still text such as "1,170" in quotes.
SALES_TEXT = StructType(_fields(StringType(), "code", "product", "region", *_SALES_NUMBERS))

EMPLOYEE_JSON = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("age", LongType()),
    ]
)
EMPLOYEE_CSV = StructType(
    [
        StructField("id", IntegerType()),
        StructField("name", StringType()),
        StructField("age", IntegerType()),
    ]
)
EMPLOYEE_TABLE = StructType(
    [
        StructField("name", StringType(), False),
        StructField("gender", StringType(), False),
        StructField("Age", IntegerType(), False),
    ]
)

# Message bodies carry text in every field; casts follow after parsing.
PERSON_MESSAGE = StructType(_fields(StringType(), "name", "age", "sex"))
PAIR_MESSAGE = StructType(
    _fields(StringType(), "lat1", "lon1", "lat2", "lon2", "time1", "time2", "dist")
)

CENSUS_NUMBERS = (
    "age",
    "fnlwgt",
    "education_num",
    "capital_gain",
    "capital_loss",
    "hours_per_week",
)
CENSUS_ATTRIBUTES = (
    "age",
    "workclass",
    "fnlwgt",
    "education",
    "education_num",
    "marital_status",
    "occupation",
    "relationship",
    "race",
    "sex",
    "capital_gain",
    "capital_loss",
    "hours_per_week",
    "native_country",
)
CENSUS = StructType(_fields(StringType(), *CENSUS_ATTRIBUTES, "label"))

IRIS_FEATURES = ("sepal_length", "sepal_width", "petal_length", "petal_width")
IRIS = StructType(_fields(DoubleType(), *IRIS_FEATURES) + _fields(StringType(), "label"))
