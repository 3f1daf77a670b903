import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.typemap import map_catalogue, mapped_schema, target_type

# type text -> (target type, Spark type, problem)
EXPECTED = {
    "tinyint": ("Int8", "tinyint", None),
    "smallint": ("Int16", "smallint", None),
    "mediumint": ("Int32", "int", None),
    "int": ("Int32", "int", None),
    "bigint": ("Int64", "bigint", None),
    "tinyint(4)": ("Int32", "int", None),
    "smallint(6)": ("Int32", "int", None),
    "mediumint(9)": ("Int32", "int", None),
    "tinyint unsigned": ("UInt32", "bigint", None),
    "int unsigned": ("UInt32", "bigint", None),
    "INT(10) UNSIGNED ZEROFILL": ("UInt32", "bigint", None),
    "bigint(20)": ("Int64", "bigint", None),
    "bigint(20) unsigned": ("UInt64", "decimal(20,0)", None),
    "float": ("Float32", "float", None),
    "float unsigned": ("Float32", "float", None),
    "double": ("Float64", "double", None),
    "double unsigned": ("Float64", "double", None),
    "datetime": ("DateTime", "timestamp", None),
    "datetime(6)": ("DateTime", "timestamp", None),
    "timestamp": ("DateTime", "timestamp", None),
    "date": ("Date", "date", None),
    "decimal(10,2)": ("Decimal(10,2)", "decimal(10,2)", None),
    "decimal(10,2) unsigned": ("Decimal(10,2)", "decimal(10,2)", None),
    "decimal (3, 6 )": ("Decimal(3,6)", None, "decimal scale above precision"),
    "decimal(10)": (None, None, "decimal without precision and scale"),
    "decimal": (None, None, "decimal without precision and scale"),
    "decimal(39,0)": ("Decimal(39,0)", None, "decimal precision above 38"),
    "bit(1)": ("UInt8", "smallint", None),
    "bit(8)": ("UInt64", "bigint", None),
    "bit(64)": ("UInt64", "decimal(20,0)", None),
    "boolean": ("UInt8", "smallint", None),
    "varchar(20)": ("String", "string", None),
    "char(1)": ("String", "string", None),
    "text": ("String", "string", None),
    "blob": ("String", "string", None),
    "json": ("String", "string", None),
    "time": ("String", "string", None),
    "year": ("String", "string", None),
    "point": ("String", "string", None),
    "enum('print')": ("String", "string", None),
    "enum('update')": ("String", "string", None),
    "set('habit')": ("String", "string", None),
    "enum('unsigned')": ("String", "string", None),
}


def test_every_type_text(spark):
    rows = [(text, nullable) for text in EXPECTED for nullable in (True, False)]
    mapped = map_catalogue(spark.createDataFrame(rows, "type_text string, nullable boolean")).collect()
    assert len(mapped) == len(rows)
    for row in mapped:
        target, kind, problem = EXPECTED[row.type_text]
        wrapped = f"Nullable({target})" if row.nullable and target else target
        assert (row.target_type, row.spark_type, row.problem) == (wrapped, kind, problem), row.type_text


def test_target_type_without_nullability(spark):
    row = spark.range(1).select(target_type(F.lit("decimal (3, 6 )")).alias("t")).first()
    assert row.t == "Decimal(3,6)"


def test_mapped_schema(spark):
    schema = mapped_schema(spark, [("id", "bigint(20) unsigned", False), ("price", "decimal(10,2)", True)])
    assert schema == T.StructType([
        T.StructField("id", T.DecimalType(20, 0), False), T.StructField("price", T.DecimalType(10, 2), True)])


@pytest.mark.parametrize("text", ["decimal (3, 6 )", "decimal(10)", "decimal(39,0)"])
def test_mapped_schema_names_the_column(spark, text):
    with pytest.raises(ValueError, match="column price"):
        mapped_schema(spark, [("id", "int", False), ("price", text, True)])
