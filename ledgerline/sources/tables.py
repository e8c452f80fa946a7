"""Named sources: a name resolves to a file by a template, with its declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Declared schemas: nothing is inferred when a job starts.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class SourceRegistry:
    """Maps source names to locations through one template, and to views on request.

    ``registry.orders`` and ``registry["orders"]`` both give the typed scan.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        template: str = "{root}/{name}.parquet",
        schemas: dict[str, str] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.template = template
        self.schemas = SCHEMAS if schemas is None else schemas

    def location(self, name: str) -> str:
        if name not in self.schemas:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self.schemas)}")
        return self.template.format(root=self.root, name=name)

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(self.location(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS and name not in self.__dict__.get("schemas", {}):
            raise AttributeError(name)
        return self[name]

    def register_views(self, prefix: str = "") -> dict[str, str]:
        """Create one temp view per source and return view name -> location."""
        made = {}
        for name in self.schemas:
            self[name].createOrReplaceTempView(prefix + name)
            made[prefix + name] = self.location(name)
        return made


def text_schema(columns: list[str]) -> T.StructType:
    """Every column a string: typing happens in the transform, so defects survive the load."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
