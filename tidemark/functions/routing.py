"""Topic name -> table folder -> (schema, table)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA_INFIX = ".schema/"


def table_folder(topic: Column, prefix: str = "") -> Column:
    """``oracle.HR.EMP`` with prefix ``oracle`` -> ``HR.schema/EMP``.

    Without an inner dot there is no schema part and every dot becomes ``_``.
    """
    name = topic
    if prefix.strip():
        head = f"{prefix}."
        name = F.when(
            topic.startswith(head), F.substring(topic, F.lit(len(head) + 1), F.length(topic))
        ).otherwise(topic)
    dot = F.instr(name, ".")
    size = F.length(name)
    schema = F.substring(name, F.lit(1), dot - 1)
    table = F.translate(F.substring(name, dot + 1, size), ".", "_")
    return F.when(
        (dot > 1) & (dot < size), F.concat(schema, F.lit(SCHEMA_INFIX), table)
    ).otherwise(F.translate(name, ".", "_"))


def folder_schema(folder: Column) -> Column:
    at = F.instr(folder, SCHEMA_INFIX)
    return F.when(at > 1, F.substring(folder, F.lit(1), at - 1)).otherwise(folder)


def folder_table(folder: Column) -> Column:
    at = F.instr(folder, SCHEMA_INFIX)
    rest = F.substring(folder, at + len(SCHEMA_INFIX), F.length(folder))
    return F.when(at > 1, rest).otherwise(folder)


def catalog_name(folder: Column) -> Column:
    """``SCHEMA.TABLE`` as the catalog spells it (upper case)."""
    return F.upper(F.concat_ws(".", folder_schema(folder), folder_table(folder)))
