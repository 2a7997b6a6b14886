"""The semantic model of products, compiled to nested structs and text.

All of a table's or product's rows meet once, in ordered ``collect_list`` structs whose first
field is the sort key; fields are declared in the order they are emitted. A model that is too
large for a row is emitted in pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FORMAT_VERSION = "0.1.1"
DIALECT = "ANSI_SQL"


def extension(kind: str, ident: Column, version: Column | None = None, **attributes: Column) -> Column:
    """Vendor extension: a JSON string with alphabetical keys."""
    fields = {"attributes": F.struct(*[attributes[k].alias(k) for k in sorted(attributes)]) if attributes else None,
              "id": ident, "kind": F.lit(kind), "version": version}
    present = [c.alias(k) for k, c in fields.items() if c is not None]
    return F.struct(F.lit("FATHOM").alias("vendor_name"), F.to_json(F.struct(*present)).alias("data"))


def ai_context(synonyms: Column, instructions: Column, examples: Column) -> Column:
    """Only the members that hold something; null if none does."""
    def some(c):
        return F.when(F.size(c) > 0, c)

    any_ = (F.size(synonyms) > 0) | (F.coalesce(F.length(instructions), F.lit(0)) > 0) | (F.size(examples) > 0)
    return F.when(any_, F.struct(some(synonyms).alias("synonyms"), F.when(F.length(instructions) > 0, instructions).alias("instructions"),
                                 some(examples).alias("examples")))


def fields(columns: DataFrame) -> DataFrame:
    """(table_id, fields, primary_key) of columns (table_id, column_id, ordinal, name, data_type,
    nullable, primary_key, description)."""
    f = F.struct("ordinal", "column_id", F.struct(
        F.col("name"), F.struct(F.array(F.struct(F.lit(DIALECT).alias("dialect"), F.col("name").alias("expression"))).alias("dialects")).alias("expression"),
        F.when(F.length("description") > 0, F.col("description")).alias("description"),
        F.array(extension("field", F.col("column_id"), None, data_type=F.col("data_type"), nullable=F.col("nullable"))).alias("custom_extensions")).alias("f"),
        F.col("primary_key").alias("key"))
    rows = columns.groupBy("table_id").agg(F.sort_array(F.collect_list(f)).alias("rows"))
    keys = F.transform(F.filter("rows", lambda r: r["key"]), lambda r: r["f"]["name"])
    return rows.select("table_id", F.transform("rows", lambda r: r["f"]).alias("fields"), F.when(F.size(keys) > 0, keys).alias("primary_key"))


def _dataset() -> Column:
    return F.struct(
        F.col("dataset").alias("name"), "source", "primary_key",
        F.when(F.length("description") > 0, F.col("description")).alias("description"), "fields",
        F.array(extension("table", F.col("table_id"), F.col("version"))).alias("custom_extensions"))


def _relationship() -> Column:
    return F.struct(
        "name", F.col("from_dataset").alias("from"), F.col("to_dataset").alias("to"), F.array("from_column").alias("from_columns"),
        F.array("to_column").alias("to_columns"))


def _metric() -> Column:
    return F.struct(
        "name", F.struct(F.array(F.struct(F.lit(DIALECT).alias("dialect"), F.col("expression"))).alias("dialects")).alias("expression"),
        F.when(F.length("description") > 0, F.col("description")).alias("description"))


def compile_models(products: DataFrame, tables: DataFrame, columns: DataFrame, relationships: DataFrame,
                   metrics: DataFrame) -> DataFrame:
    """(product_id, model): the JSON model of every product, each in one row; :func:`model_pieces` has no such bound.

    ``tables``: product_id, table_id, version, dataset, source, description. ``relationships``:
    product_id, relationship_id, name, from_dataset, to_dataset, from_column, to_column.
    ``metrics``: product_id, metric_id, name, expression, description.
    """
    d = tables.join(fields(columns), "table_id", "left")
    dataset = F.struct("table_id", _dataset().alias("d"))
    datasets = d.groupBy("product_id").agg(F.transform(F.sort_array(F.collect_list(dataset)), lambda x: x["d"]).alias("datasets"))
    rel = F.struct("relationship_id", _relationship().alias("r"))
    rels = relationships.groupBy("product_id").agg(F.transform(F.sort_array(F.collect_list(rel)), lambda x: x["r"]).alias("relationships"))
    met = F.struct("metric_id", _metric().alias("m"))
    mets = metrics.groupBy("product_id").agg(F.transform(F.sort_array(F.collect_list(met)), lambda x: x["m"]).alias("metrics"))
    j = (products.join(datasets, "product_id", "left").join(rels, "product_id", "left").join(mets, "product_id", "left"))
    model = F.struct(F.lit(FORMAT_VERSION).alias("version"), F.array(F.struct(
        F.col("name"), F.when(F.length("description") > 0, F.col("description")).alias("description"), "datasets", "relationships", "metrics",
        F.array(extension("product", F.col("product_id"), F.col("version"))).alias("custom_extensions"))).alias("semantic_model"))
    return j.select("product_id", F.to_json(model).alias("model"))


def model_pieces(products: DataFrame, tables: DataFrame, columns: DataFrame, relationships: DataFrame,
                 metrics: DataFrame) -> DataFrame:
    """(product_id, section, position, text): the JSON model of every product in pieces.

    A product's pieces, concatenated by section and position, are the text of :func:`compile_models`. A piece is
    a table, a relationship or a metric, so no row holds a product. Sections: 0 head, 1 datasets, 2 relationships,
    3 metrics, 4 tail; positions count from 1.
    """
    known = products.select("product_id").distinct()

    def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
        w = Window.partitionBy("product_id")
        return rows.join(known, "product_id", "left_semi").withColumn("position", F.row_number().over(w.orderBy(*order))).withColumn(
            "_last", F.col("position") == F.count("*").over(w))

    def section(rows: DataFrame, number: int, name: str, value: Column) -> DataFrame:
        text = F.concat(F.when(F.col("position") == 1, f'"{name}":[').otherwise(""), F.to_json(value), F.when(F.col("_last"), "],").otherwise(","))
        return rows.select("product_id", F.lit(number).alias("section"), "position", text.alias("text"))

    # Tables are numbered before they get their fields; those come by merge, as a table's fields are long.
    t = numbered(tables, ["table_id", "dataset", "source", "description", "version"]).join(fields(columns).hint("merge"), "table_id", "left")
    r = numbered(relationships, ["relationship_id", "name", "from_dataset", "to_dataset", "from_column", "to_column"])
    m = numbered(metrics, ["metric_id", "name", "expression", "description"])
    named = F.to_json(F.struct("name", F.when(F.length("description") > 0, F.col("description")).alias("description")))
    open_ = F.concat(F.lit(f'{{"version":"{FORMAT_VERSION}","semantic_model":[{{'), F.expr("substring(_named, 2, length(_named) - 2)"), F.when(F.col("_named") == "{}", "").otherwise(","))
    head = products.withColumn("_named", named).select("product_id", F.lit(0).alias("section"), F.lit(1).alias("position"), open_.alias("text"))
    own = F.to_json(F.array(extension("product", F.col("product_id"), F.col("version"))))
    tail = products.select("product_id", F.lit(4).alias("section"), F.lit(1).alias("position"), F.concat(F.lit('"custom_extensions":'), own, F.lit("}]}")).alias("text"))
    return (head.unionByName(section(t, 1, "datasets", _dataset())).unionByName(section(r, 2, "relationships", _relationship()))
            .unionByName(section(m, 3, "metrics", _metric())).unionByName(tail))


def unresolved_references(relationships: DataFrame, tables: DataFrame) -> DataFrame:
    """Relationships whose dataset is not one of the product's."""
    t = tables.select("product_id", "dataset")
    ends = relationships.select("product_id", "relationship_id", F.explode(F.array("from_dataset", "to_dataset")).alias("dataset"))
    return ends.join(t, ["product_id", "dataset"], "left_anti").select("product_id", "relationship_id").distinct()


def dictionary_json(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """(product_id, dictionary): tables and columns as JSON with alphabetical keys."""
    col = F.struct("ordinal", F.struct("data_type", "description", "name", "nullable", "ordinal", "primary_key").alias("c"))
    c = columns.groupBy("table_id").agg(F.transform(F.sort_array(F.collect_list(col)), lambda x: x["c"]).alias("columns"))
    t = tables.join(c, "table_id", "left")
    tab = F.struct("table_id", F.struct("columns", "description", F.col("dataset").alias("name"), "table_id", "version").alias("t"))
    return t.groupBy("product_id").agg(F.to_json(F.struct(F.transform(
        F.sort_array(F.collect_list(tab)), lambda x: x["t"]).alias("tables"))).alias("dictionary"))


def product_markdown(products: DataFrame, facts: DataFrame, sections: DataFrame) -> DataFrame:
    """(product_id, markdown): a title, the description, and facts by section.

    ``facts``: product_id, kind, value. ``sections``: kind, position, title (a static table).
    Values of a section are ordered in any case, then as written.
    """
    f = facts.join(F.broadcast(sections), "kind").groupBy("product_id", "position", "title").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(F.lower("value").alias("k"), "value"))), lambda x: F.concat(F.lit("- "), x["value"])), "\n").alias("items"))
    s = f.groupBy("product_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
        "position", F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.col("items")).alias("part")))), lambda x: x["part"]), "\n\n").alias("body"))
    j = products.join(s, "product_id", "left")
    return j.select("product_id", F.concat(F.concat_ws("\n\n", F.concat(F.lit("# "), F.col("name")),
                                                       F.when(F.length("description") > 0, F.col("description")), F.col("body")), F.lit("\n")).alias("markdown"))


def apply_suggestions(described: DataFrame, suggestions: DataFrame, least: float = 0.7) -> DataFrame:
    """Entities (path, description, synonyms) with suggestions of enough confidence.

    ``suggestions``: path, position, description, synonyms, confidence. A description fills an
    empty one only, the first suggested; the last suggested synonyms replace the old.
    """
    good = suggestions.where(F.col("confidence") >= least)
    picked = good.groupBy("path").agg(
        F.min_by("description", F.when(F.length("description") > 0, F.col("position"))).alias("new_description"),
        F.max_by("synonyms", F.when(F.size("synonyms") > 0, F.col("position"))).alias("new_synonyms"))
    j = described.join(picked, "path", "left")
    return j.select("path", F.when(F.length("description") > 0, F.col("description")).otherwise(F.col("new_description")).alias("description"),
                    F.coalesce("new_synonyms", "synonyms").alias("synonyms"))
