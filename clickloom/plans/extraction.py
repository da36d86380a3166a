"""Id pairs out of parsed display and page-view logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import blank_to_null
from clickloom.operators.joins import dictionary_lookup
from clickloom.operators.loglines import field_count
from clickloom.schemas import ID_TYPES

# Placeholder user id, length above which a hashed channel's id is hashed.
MOCKED_ID = "MOCKEDGUIID"
LONGEST_PLAIN_ID = 32
OLD_LAYOUT_FIELDS = 16


def display_pairs(logs: DataFrame) -> DataFrame:
    """(time, channel, guid, agsid) -> pairs of channel id and cookie id; both must be there."""
    id_type = None
    for name in ("adx", "baidu", "tanx"):
        code = F.lit(str(ID_TYPES[name]))
        test = F.col("channel") == name
        id_type = F.when(test, code) if id_type is None else id_type.when(test, code)
    hashed = (id_type == str(ID_TYPES["baidu"])) & (F.length("guid") > LONGEST_PLAIN_ID)
    guid = F.when(F.col("guid") == MOCKED_ID, None).when(hashed, F.md5("guid")).otherwise(F.col("guid"))
    rows = logs.select(
        "time", blank_to_null(guid).alias("id1"), id_type.alias("id1_type"),
        blank_to_null(F.col("agsid")).alias("id2"), F.lit(str(ID_TYPES["agsid"])).alias("id2_type"),
    )
    return rows.where(F.col("id1").isNotNull() & F.col("id2").isNotNull() & F.col("id1_type").isNotNull())


def page_view_pairs(views: DataFrame, clients: DataFrame) -> DataFrame:
    """(time, agsid, query, line) -> pairs of client-scoped first-party id and cookie id.

    ``clients``: client code, client id. A new-layout line without a first-party
    id is left out; an old-layout line keeps its cookie id alone.
    """
    def query_value(name: str):
        return blank_to_null(F.regexp_extract(F.col("query"), rf"{name}=(\w*)", 1))

    coded = views.withColumn("__agfid", query_value("agfid")).withColumn("__client_code", query_value("atscu"))
    known = dictionary_lookup(coded, clients, "__client_code", "client_code", "client_id", "__client",
                              F.lit(None).cast("string"))
    fid = F.when(
        F.col("__client").isNotNull() & F.col("__agfid").isNotNull(), F.concat_ws("_", "__client", "__agfid")
    )
    is_old = field_count(F.col("line")) == OLD_LAYOUT_FIELDS
    cookie = F.when(is_old | fid.isNotNull(), F.translate(blank_to_null(F.col("agsid")), "\t", ""))
    return known.select(
        "time", fid.alias("id1"), F.lit(str(ID_TYPES["agfid"])).alias("id1_type"),
        cookie.alias("id2"), F.lit(str(ID_TYPES["agsid"])).alias("id2_type"),
    ).where(F.col("id2").isNotNull())


def all_pairs(display: DataFrame, views: DataFrame) -> DataFrame:
    return display.unionByName(views)
