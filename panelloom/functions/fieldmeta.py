"""Labels and formats of survey variables as metadata of Spark fields.

Expressions and aggregates drop field metadata, so a stage re-attaches it at its end; Parquet keeps it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Dictionary:
    """Variable labels, value labels (code -> text) and display formats by column name."""

    labels: dict[str, str] = field(default_factory=dict)
    values: dict[str, dict[float, str]] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)

    def renamed(self, names: dict[str, str]) -> Dictionary:
        """The same for columns under other names; columns that aren't named are left out."""
        pick = lambda d: {names[k]: v for k, v in d.items() if k in names}
        return Dictionary(pick(self.labels), pick(self.values), pick(self.formats))

    def merged(self, other: Dictionary) -> Dictionary:
        """Both; the other's entries win."""
        return Dictionary(self.labels | other.labels, self.values | other.values, self.formats | other.formats)


def attach(df: DataFrame, d: Dictionary) -> DataFrame:
    """df with the dictionary on its fields."""
    columns = []
    for f in df.schema.fields:
        meta = {}
        if f.name in d.labels:
            meta["variable_label"] = d.labels[f.name]
        if d.values.get(f.name):
            meta["value_labels"] = {repr(float(k)): v for k, v in d.values[f.name].items()}
        if f.name in d.formats:
            meta["spss_format"] = d.formats[f.name]
        columns.append(F.col(f"`{f.name.replace('`', '``')}`").alias(f.name, metadata=meta))
    return df.select(*columns)


def read(df: DataFrame) -> Dictionary:
    """The dictionary that df's fields carry."""
    d = Dictionary()
    for f in df.schema.fields:
        if "variable_label" in f.metadata:
            d.labels[f.name] = f.metadata["variable_label"]
        if f.metadata.get("value_labels"):
            d.values[f.name] = {float(k): v for k, v in f.metadata["value_labels"].items()}
        if "spss_format" in f.metadata:
            d.formats[f.name] = f.metadata["spss_format"]
    return d
