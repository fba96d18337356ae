"""Problem 7: schemas that drift between files."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Names under which a field of each role is known to come, the most usual first.
ROLE_NAMES = {
    "smiles_original": ("smiles_original", "canonical_smiles", "SMILES", "smiles", "SMILES_Solute", "smi", "Structure (SMILES)"),
    "solvent": ("solvent", "Solvent", "Medium", "medium_name", "SMILES_Solvent", "Solvent (Solubility (MCS))"),
    "logS": ("logS", "LogS", "logS_molL", "Solubility", "Y", "LogS(mol/L)", "log_solubility"),
    "source": ("source", "Source", "dataset", "origin", "data_origin"),
}
#: Roles of names that are in no list, by the words in them; the first that fits holds ("SMILES_Solvent" is a solvent).
ROLE_WORDS = (
    ("solvent", r"(?i)solvent|(?<![a-z])medium(?![a-z])"),
    ("smiles_original", r"(?i)smiles|(?<![a-z])smi(?![a-z])|(?<![a-z])(mol(ecule)?_?)?structure(?![a-z])"),
    ("logS", r"(?i)(?<![a-z])log_?s(?![a-z])|solubility"),
    ("source", r"(?i)(?<![a-z])(data_?)?(source|origin|set)(?![a-z])|(?<![a-z])dataset(?![a-z])|provenance"),
)
#: Type lattice of JSON: null is below all; two different types meet in string, the type that can hold either as text.
KINDS = ("string", "number", "boolean", "array", "object")


def role_of(name: str) -> str | None:
    """The role that a JSON name stands for, or None."""
    for role, names in ROLE_NAMES.items():
        if name in names:
            return role
    return next((role for role, words in ROLE_WORDS if re.search(words, name)), None)


def _role(name: Column) -> Column:
    listed = F.create_map(*[F.lit(x) for role, names in ROLE_NAMES.items() for n in names for x in (n, role)])
    by_words = None
    for role, words in ROLE_WORDS:
        by_words = F.when(name.rlike(words), role) if by_words is None else by_words.when(name.rlike(words), role)
    return F.coalesce(listed[name], by_words)


def _place(name: Column) -> Column:
    """Place of the name in its role's list; names that are in no list come last."""
    return F.coalesce(F.create_map(*[F.lit(x) for names in ROLE_NAMES.values() for i, n in enumerate(names) for x in (n, i)])[name], F.lit(99))


def _kind(value: Column) -> Column:
    """JSON type of a variant, null for a JSON null."""
    s = F.schema_of_variant(value)
    return (
        F.when(s == "VOID", None)
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "BOOLEAN", "boolean")
        .when(s.rlike("^(BIGINT|TINYINT|SMALLINT|INT|DOUBLE|FLOAT|DECIMAL)"), "number")
        .otherwise("string")
    )


def file_headers(raw: DataFrame) -> DataFrame:
    """(feed, file_seq, fields) per file; fields is {field: (name, kind)}, where field is the role or the JSON name.

    Every record is parsed where it lies and only (file, name, type) counts are shuffled, pre-aggregated, so a feed
    or file that holds a third of all rows costs one row per field. kind is the type lattice's join of the non-null
    values, null if there are none. Of two names with one role in a file, the more usual one has the role (then the
    one in more records); the other stays under its own name. Payloads that are no JSON object add no field; their
    file still counts as a file. Rows without feed or file_seq are in no file.
    """
    rows = raw.where("feed IS NOT NULL AND file_seq IS NOT NULL").select("feed", "file_seq", F.try_parse_json("payload").alias("v"))
    files = rows.select("feed", "file_seq").distinct()
    view = f"limpid_drift_{uuid.uuid4().hex}"
    rows.where("v IS NOT NULL AND schema_of_variant(v) LIKE 'OBJECT%'").createOrReplaceTempView(view)
    pairs = rows.sparkSession.sql(f"SELECT feed, file_seq, e.key AS name, e.value AS value FROM {view}, LATERAL variant_explode(v) AS e")
    rows.sparkSession.catalog.dropTempView(view)
    counts = pairs.select("feed", "file_seq", "name", _kind(F.col("value")).alias("kind")).groupBy("feed", "file_seq", "name", "kind").agg(F.count("*").alias("n"))
    per = counts.groupBy("feed", "file_seq", "name").agg(F.sum("n").alias("n"), F.collect_set("kind").alias("kinds"))
    per = per.withColumn("kind", F.when(F.size("kinds") == 1, F.col("kinds")[0]).when(F.size("kinds") > 1, "string"))
    per = per.withColumn("role", _role(F.col("name")))
    first = F.row_number().over(Window.partitionBy("feed", "file_seq", "role").orderBy(_place(F.col("name")), F.desc("n"), "name"))
    per = per.withColumn("field", F.when(F.col("role").isNotNull() & (first == 1), F.col("role")).otherwise(F.col("name")))
    # a name that is the role of another field here keeps a field of its own
    clash = F.row_number().over(Window.partitionBy("feed", "file_seq", "field").orderBy((F.col("field") != F.coalesce("role", F.lit(""))).cast("int"), "name"))
    per = per.withColumn("field", F.when(clash == 1, F.col("field")).otherwise(F.concat(F.col("name"), F.lit("#"), clash.cast("string"))))
    heads = per.groupBy("feed", "file_seq").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", F.struct("name", "kind").alias("at"))))).alias("fields"))
    return files.join(heads, ["feed", "file_seq"], "left").withColumn("fields", F.coalesce("fields", F.expr("CAST(map() AS map<string, struct<name: string, kind: string>>)")))


def schema_changes(raw: DataFrame) -> DataFrame:
    """(feed, file_seq, field, change_kind, before, after): every change of a file against the one before it in its feed.

    change_kind: added, removed, renamed (before and after are names), retyped (types). The first file of a feed has
    no changes. A field that only holds nulls in one of two files is not retyped between them. Files are ordered by
    file_seq, whenever they came in; an empty table gives an empty result.
    """
    w = Window.partitionBy("feed").orderBy("file_seq")
    pair = file_headers(raw).withColumn("last", F.lag("fields").over(w)).where("last IS NOT NULL")
    each = pair.select("feed", "file_seq", "fields", "last", F.explode(F.array_union(F.map_keys("fields"), F.map_keys("last"))).alias("field"))
    each = each.select("feed", "file_seq", "field", F.try_element_at("fields", F.col("field")).alias("now"), F.try_element_at("last", F.col("field")).alias("old"))
    kinds = F.array(
        F.when(F.col("old").isNull(), F.struct(F.lit("added").alias("change_kind"), F.lit(None).cast("string").alias("before"), F.col("now.name").alias("after"))),
        F.when(F.col("now").isNull(), F.struct(F.lit("removed").alias("change_kind"), F.col("old.name").alias("before"), F.lit(None).cast("string").alias("after"))),
        F.when(F.col("now.name") != F.col("old.name"), F.struct(F.lit("renamed").alias("change_kind"), F.col("old.name").alias("before"), F.col("now.name").alias("after"))),
        F.when(F.col("now.kind") != F.col("old.kind"), F.struct(F.lit("retyped").alias("change_kind"), F.col("old.kind").alias("before"), F.col("now.kind").alias("after"))),
    )
    return each.select("feed", "file_seq", "field", F.inline(F.filter(kinds, lambda x: x.isNotNull())))


def _scalar(text: Column, kind: Column) -> Column:
    """The value inside an array (its first) or object (its name, value or lab, else null); anything else as it is."""
    return F.when(kind == "array", F.get_json_object(text, "$[0]")).when(kind == "object", F.coalesce(*[F.get_json_object(text, f"$.{k}") for k in ("value", "name", "lab")])).otherwise(text)


def one_table(raw: DataFrame) -> DataFrame:
    """All records under fixed columns: raw_id, feed, file_seq, line_no, received_at, smiles_original, solvent, logS,
    source, and ``other``, a map of the remaining fields as text.

    Each file is cast by its own header. logS is read as a number, also from text with a decimal comma; what is no
    number becomes null. Records whose payload is no JSON object keep their row with null fields.
    """
    heads = file_headers(raw)
    rows = raw.join(heads, ["feed", "file_seq"], "left").withColumn("_m", F.from_json("payload", "map<string,string>"))

    def role(r: str) -> Column:
        at = F.try_element_at("fields", F.lit(r))
        text = F.try_element_at("_m", at["name"])
        # a record may hold another type than its file's: look at the text itself
        kind = F.when(text.rlike(r'^\s*\{.*\}\s*$'), "object").when((at["kind"] == "array") & text.startswith("["), "array")
        return _scalar(text, F.coalesce(kind, F.lit("scalar")))

    names = F.transform(F.array(*[F.lit(r) for r in ROLE_NAMES]), lambda r: F.try_element_at(F.col("fields"), r)["name"])
    other = F.map_filter("_m", lambda k, v: ~F.coalesce(F.array_contains(names, k), F.lit(False)))
    number = F.regexp_replace(role("logS"), r"^\s*([-+]?\d+),(\d+)\s*$", "$1.$2").try_cast("double")
    return rows.select("raw_id", "feed", "file_seq", "line_no", "received_at", role("smiles_original").alias("smiles_original"), role("solvent").alias("solvent"), number.alias("logS"), role("source").alias("source"), other.alias("other"))
