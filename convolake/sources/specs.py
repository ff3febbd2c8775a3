"""API specifications in JSON files of three layouts, read as tables of tools, endpoints and parameters.

A file is one row of text; everything else is expressions over VARIANT values, so fields of any type and order work.
Files that are not JSON objects, or tools whose id can't be made, are left out (or raise, if malformed ones are not to
be skipped). Of tools with one id the first path counts, of endpoints with one id the first in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import endpoint_id, infer_domain, normalize_method, normalize_type, tool_id, truncate

PARAMETER = "struct<name:string,type:string,description:string,required:boolean,default:string,enum:array<string>>"
# Names of folders that say nothing about a tool's category.
PLAIN_FOLDERS = ("tools", "toolbench", "data")


def scan(spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = True, limit: int | None = None) -> DataFrame:
    """(path, raw) of files; a limit takes the first paths in order."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return files.orderBy("path").limit(limit) if limit is not None else files


def scan_lines(spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = True) -> DataFrame:
    """S1 for files of one specification a line, where a file each would cost more than its reading: (path, raw).

    A path is the file's, its name preceded by the line's MD5 sum: it tells lines apart and puts them in an order.
    """
    lines = spark.read.text(path, lineSep="\n", pathGlobFilter=pattern, recursiveFileLookup=recursive)
    named = F.regexp_replace(F.col("_metadata.file_path"), F.lit("([^/]+)$"), F.concat(F.md5("value"), F.lit("-$1")))
    return lines.select(named.alias("path"), F.col("value").alias("raw"))


def _kind(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def _get(v: Column, *names: str) -> Column:
    """The first of these fields that is neither missing nor empty, zero or false, as a string."""

    def one(name: str) -> Column:
        text = F.try_variant_get(v, f"$.{name}", "string")
        nothing = (text == "") | (text.isin("0", "0.0", "-0", "-0.0", "false") & (_kind(v, name) != "STRING"))
        return F.when(~nothing, text)

    return F.coalesce(*[one(n) for n in names])


def _list(v: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))


def _json(v: Column, name: str) -> Column:
    return F.to_json(F.try_variant_get(v, f"$.{name}", "variant"))


#: Names of a parameter's type and description: in lists, and in objects.
IN_LIST, IN_OBJECT = (("type", "parameter_type", "param_type"), ("description", "parameter_description")), (("type", "parameter_type"), ("description",))


def _required(p: Column, else_: bool) -> Column:
    """A text must be "true", a number not zero; null is false, a missing field is else_."""
    kind, get = _kind(p, "required"), lambda type_: F.try_variant_get(p, "$.required", type_)
    known = F.when(kind == "VOID", False).when(kind == "STRING", F.lower(get("string")) == "true").when(kind == "BOOLEAN", get("boolean"))
    return F.when(kind.isNull(), else_).otherwise(F.coalesce(known, get("double") != 0, ~get("string").isin("[]", "{}")))


def _parameter(p: Column, name: Column, required: bool, most: int, names: tuple = IN_LIST) -> Column:
    needed = _required(p, required)
    return F.struct(
        name.alias("name"), normalize_type(_get(p, *names[0])).alias("type"), truncate(F.coalesce(_get(p, *names[1]), F.lit("")), most).alias("description"),
        needed.alias("required"), F.when(F.schema_of_variant(F.try_variant_get(p, "$.default", "variant")) != "VOID", _json(p, "default")).alias("default"),
        F.transform(F.try_variant_get(p, "$.enum", "array<variant>"), lambda x: F.to_json(x)).alias("enum"),
    )


def parameters_of_list(items: Column, required: bool = False, most: int = 500) -> Column:
    """Parameters with a name, of an array of variants."""
    name = lambda p: _get(p, "name", "parameter_name", "param_name")
    return F.transform(F.filter(items, lambda p: name(p).isNotNull()), lambda p: _parameter(p, name(p), required, most))


def parameters_of_object(v: Column, name: str, most: int = 500) -> Column:
    """An object's keys are the names; values that are no objects are passed over."""
    entries = F.map_entries(F.try_variant_get(v, f"$.{name}", "map<string,variant>"))
    objects = F.filter(entries, lambda e: F.schema_of_variant(e["value"]).startswith("OBJECT"))
    return F.coalesce(F.transform(objects, lambda e: _parameter(e["value"], e["key"], False, most, IN_OBJECT)), F.array().cast(f"array<{PARAMETER}>"))


def _parameters(v: Column, most: int) -> Column:
    """The general parameters field: a list or an object."""
    is_list = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.parameters", "variant")).startswith("ARRAY"), F.lit(False))
    return F.when(is_list, parameters_of_list(_list(v, "parameters"), most=most)).otherwise(parameters_of_object(v, "parameters", most))


def layout(v: Column) -> Column:
    """S3: which field holds the endpoints; a tool without any is of the first layout."""
    has = lambda name: F.try_variant_get(v, f"$.{name}", "variant").isNotNull()
    return F.when(has("api_list"), "api_list").when(has("endpoints"), "endpoints").when(has("apis"), "apis").otherwise("api_list")


def folder_category(path: Column) -> Column:
    """The parent folder's name, with spaces, unless it says nothing."""
    folder = F.regexp_extract(path, "([^/]+)/[^/]*$", 1)
    return F.when((folder != "") & ~F.lower(folder).isin(*PLAIN_FOLDERS), F.replace(folder, F.lit("_"), F.lit(" ")))


def parse_tools(files: DataFrame, most: int = 500, skip_malformed: bool = True) -> DataFrame:
    """(id, name, category, description, api_host, layout, raw, items) of files(path, raw)."""
    v = F.try_parse_json("raw") if skip_malformed else F.parse_json("raw")
    read = files.withColumn("v", v).where(F.schema_of_variant("v").startswith("OBJECT")).withColumn("layout", layout(F.col("v")))
    d, first, kind = F.col("v"), lambda *n: _get(F.col("v"), *n), F.col("layout")
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    id_ = tool_id(first("id"), first("tool_id"), first("tool_name"), first("name"), stem, "raw")
    name = F.when(kind == "endpoints", first("name", "tool_name")).otherwise(first("tool_name", "name"))
    category = F.when(kind == "api_list", first("category_name", "category")).otherwise(first("category", "category_name"))
    description = F.when(kind == "endpoints", first("description")).otherwise(first("description", "tool_description"))
    host = F.when(kind == "api_list", first("api_host", "host", "url")).otherwise(first("api_host", "host"))
    items = F.when(kind == "endpoints", _list(d, "endpoints")).when(kind == "apis", _list(d, "apis")).otherwise(_list(d, "api_list"))
    tools = read.select(
        "path", id_.alias("id"), F.coalesce(name, id_).alias("name"), F.coalesce(category, folder_category(F.col("path")), F.lit("Uncategorized")).alias("category"),
        truncate(F.coalesce(description, F.lit("")), most).alias("description"), F.coalesce(host, F.lit("")).alias("api_host"), "layout", "raw", items.alias("items"),
    ).where("id is not null")
    return tools.withColumn("_nth", F.row_number().over(Window.partitionBy("id").orderBy("path"))).where("_nth = 1").drop("_nth")


def parse_endpoints(tools: DataFrame, most: int = 500) -> DataFrame:
    """(id, tool_id, name, method, path, description, domain, parameters, raw) of parse_tools()."""
    e = tools.select(F.col("id").alias("tool_id"), "category", "layout", F.posexplode("items").alias("at", "e"))
    v, kind = F.col("e"), F.col("layout")
    get = lambda *n: _get(F.col("e"), *n)
    name = F.when(kind == "api_list", get("name", "api_name")).when(kind == "endpoints", get("name", "endpoint_name")).otherwise(get("api_name", "name"))
    path = F.coalesce(F.when(kind == "api_list", get("url", "path")).otherwise(get("path", "url")), F.lit(""))
    description = F.coalesce(F.when(kind == "api_list", get("description", "api_description")).when(kind == "endpoints", get("description")).otherwise(get("api_description", "description")), F.lit(""))
    listed = F.concat(parameters_of_list(_list(v, "required_parameters"), True, most), parameters_of_list(_list(v, "optional_parameters"), False, most), _parameters(v, most))
    found = e.select(
        "tool_id", "at", "category", name.alias("name"), normalize_method(get("method")).alias("method"), path.alias("path"), description.alias("d"),
        F.when(kind == "api_list", listed).otherwise(_parameters(v, most)).alias("parameters"), F.to_json("e").alias("raw"),
    ).where("name is not null")
    full = found.select(
        endpoint_id("tool_id", "name").alias("id"), "tool_id", "at", "name", "method", "path", truncate("d", most).alias("description"),
        infer_domain("category", "path", "name", "d").alias("domain"), "parameters", F.lit(None).cast("string").alias("response_schema"), "raw",
    )
    return full.withColumn("_nth", F.row_number().over(Window.partitionBy("tool_id", "id").orderBy("at"))).where("_nth = 1").drop("_nth", "at")


def required_parameters(parameters) -> Column:
    """F7."""
    return F.filter(F.col(parameters) if isinstance(parameters, str) else parameters, lambda p: p["required"])


def optional_parameters(parameters) -> Column:
    """F7."""
    return F.filter(F.col(parameters) if isinstance(parameters, str) else parameters, lambda p: ~p["required"])
