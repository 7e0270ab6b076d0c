"""Readers for the corpus sources and the benchmark, probe and prompt files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.core import let, non_blank, strip
from ..functions.dates import ymd_of_number, ymd_of_text
from ..functions.fixed import JSON_TEXT_KEYS
from ..operators.rank import checked_benchmarks
from ..session import file_system, shared_folder

SUFFIXES = ("txt", "md", "jsonl", "json")
#: Ends of lines.
LINE_ENDS = r"[\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def _named(spark: SparkSession, path: str, suffixes: tuple[str, ...]) -> dict[str, str]:
    """Reader options for the files below a folder whose suffix, in any case, is one of these; a single file counts whatever its name."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isFile():
        return {}
    any_case = ("".join(f"[{c}{c.upper()}]" for c in s) for s in suffixes)
    return {"recursiveFileLookup": "true", "pathGlobFilter": f"*.{{{','.join(any_case)}}}"}


def _found(files: DataFrame, path: str) -> DataFrame:
    if not files.inputFiles():
        raise FileNotFoundError(f"{path}: no text files")
    return files


def local_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(path, content): every text file below a folder, whole, in path order where sorted by path; a folder without any is an error."""
    files = spark.read.options(**_named(spark, path, suffixes)).text(path, wholetext=True)
    return _found(files, path).select(F.col("_metadata.file_path").alias("path"), decoded(F.col("value")).alias("content"))


def decoded(text: Column) -> Column:
    """Without bytes that aren't UTF-8, every line end a line feed."""
    valid = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
    return F.when(F.contains(valid, F.lit("\r")), F.regexp_replace(valid, "\r\n?", "\n")).otherwise(valid)


def _long(parts: Column, min_chars: int) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: F.length(x) >= max(min_chars, 1))


def text_chunks(content: Column, min_chars: int = 1) -> Column:
    """Paragraphs of at least ``min_chars`` characters; single lines where no paragraph is long enough."""
    paragraphs = _long(F.split(content, r"(?U)\n\s*\n+"), min_chars)
    return F.when(F.size(paragraphs) > 0, paragraphs).otherwise(_long(F.split(content, LINE_ENDS), min_chars))


def _string(value: Column, path: str) -> Column:
    """The string at a path of a JSON value; NULL where there is none or it is of another kind."""
    return let(F.try_variant_get(value, path, "variant"), lambda at: F.when(F.schema_of_variant(at) == "STRING", at.cast("string")))


def text_of_json(value: Column) -> Column:
    """The text of a parsed JSON value: a string itself, the first key whose value is a string with text, else prompt and completion; NULL where there is none."""
    some = lambda c: let(strip(c), non_blank)
    prompt, completion = _string(value, "$.prompt"), _string(value, "$.completion")
    pair = some(F.concat(strip(prompt), F.lit("\n"), strip(completion)))
    return F.coalesce(some(_string(value, "$")), *(some(_string(value, f"$.{k}")) for k in JSON_TEXT_KEYS), pair)


def parsed_json(text: Column) -> Column:
    """The JSON value that a text is, whole, as a variant; NULL where it isn't one.

    The parser stops behind the first value, so the text is put between brackets, where it must be
    the only item, and between braces, where nothing may close the brackets early; a text without a
    closing bracket can't.
    """
    items = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast("array<variant>")
    closed = ~F.contains(text, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return let(items, lambda xs: F.when((F.size(xs) == 1) & closed, F.get(xs, 0)))


def json_text(line: Column) -> Column:
    """``text_of_json`` of a text; NULL where it isn't JSON."""
    return let(parsed_json(line), text_of_json)


def is_json(line: Column) -> Column:
    return parsed_json(line).isNotNull()


def _line_text(line: Column) -> Column:
    """A line's text: of its JSON value, or itself where it isn't JSON."""
    return let(parsed_json(line), lambda v: F.when(v.isNotNull(), text_of_json(v)).otherwise(line))


def _whole_json(content: Column, min_chars: int) -> Column:
    """Texts of one JSON value over the whole file: of an array's items, or of itself."""
    items = lambda v: F.when(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), v.try_cast("array<variant>")).otherwise(F.array(v))
    return let(parsed_json(content), lambda v: F.filter(F.transform(items(v), text_of_json), lambda x: x.isNotNull() & (F.length(x) >= min_chars)))


def json_lines(content: Column, min_chars: int = 1, by_line: bool = True) -> Column:
    """Texts of a JSON file: of its lines, one value each, where a line that isn't JSON is its own text if long enough;
    where no line gives a text, or without ``by_line`` if there is but one line, of the whole file as an array or object."""
    whole = strip(content)
    lines = F.filter(F.transform(F.split(whole, LINE_ENDS), strip), lambda x: x != "")
    texts = F.filter(F.transform(lines, _line_text), lambda x: x.isNotNull() & (F.length(x) >= min_chars))
    lines_first = F.lit(by_line) | F.contains(whole, F.lit("\n"))
    return F.when(lines_first & (F.size(texts) > 0), texts).otherwise(F.coalesce(_whole_json(whole, min_chars), F.array().cast("array<string>")))


def local_documents(spark: SparkSession, path: str, min_chars: int = 1) -> DataFrame:
    """(path, pos, text) of all local text and JSON files, each file read whole by one task; for large files see ``split_documents``."""
    files = local_files(spark, path)
    c, name = F.col("content"), F.lower("path")
    texts = F.when(F.endswith(name, F.lit(".jsonl")), json_lines(c, min_chars)).when(F.endswith(name, F.lit(".json")), json_lines(c, min_chars, False)).otherwise(text_chunks(c, min_chars))
    return files.select("path", F.posexplode(texts).alias("pos", "text"))


def _records(rows: DataFrame) -> DataFrame:
    """(path, block, at, value) of records that Spark reads in byte ranges; a record belongs to the range in which it begins.

    ``block`` is where the range begins and ``at`` orders the records of a range.
    """
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), decoded(F.col("value")).alias("value"))


def _paragraph_records(spark: SparkSession, path: str) -> list[DataFrame]:
    """Records that end at an empty line, by the kind of a file's line ends (file names alone reach the driver)."""
    options = _named(spark, path, ("txt", "md"))
    lines = spark.read.options(**options).text(path, lineSep="\n")
    kinds = lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.bool_or(F.endswith("value", F.lit("\r"))).alias("other")).collect()
    if not any(k.other for k in kinds):
        return [_records(spark.read.options(**options).text(path, lineSep="\n\n"))]
    usual, other = (sorted(k.path for k in kinds if k.other == o) for o in (False, True))
    read = lambda paths, end: _records(spark.read.text(paths, lineSep=end))
    return [*([read(usual, "\n\n")] if usual else []), read(other, "\n\r\n")]


def split_documents(spark: SparkSession, path: str, min_chars: int = 1) -> DataFrame:
    """(path, block, at, part, text): the documents of ``local_documents`` from files of any size; (block, at, part) orders those of a file.

    Files are read in byte ranges of ``spark.sql.files.maxPartitionBytes``; Spark's reader looks
    for a record's end beyond its range. Text files end their records at an empty line, which every
    separator of paragraphs is made of. JSON files are read by lines; which of them are one JSON value
    over all their lines is told by an aggregate of each file's lines (this job runs at once), and only those files' lines
    are put together again. A single paragraph, line or such value must fit into a task, as it is one
    document; so must a text file whose lines end in carriage returns alone.
    """
    fs, p = file_system(spark, path)
    one = fs.exists(p) and fs.getFileStatus(p).isFile()
    json = p.getName().lower().endswith((".json", ".jsonl"))
    _found(spark.read.options(**_named(spark, path, SUFFIXES)).text(path), path)
    parts = []
    if not one or not json:
        paragraphs = F.posexplode(_long(F.split("value", r"(?U)\n\s*\n+"), min_chars)).alias("part", "text")
        parts += [r.select("path", "block", "at", paragraphs) for r in _paragraph_records(spark, path)]
    if not one or json:
        parts.append(_split_json(_records(spark.read.options(**_named(spark, path, ("jsonl", "json"))).text(path, lineSep="\n")), min_chars))
    return reduce(DataFrame.unionByName, parts)


def _parsed(rows: DataFrame, *keep: str) -> DataFrame:
    """``rows`` of a ``line`` with whether it is JSON (``valid``) and its ``text``, in one generator: filters on them can't be pushed below it, where each would parse the line again."""
    found = F.transform(F.array(parsed_json(F.col("line"))), lambda v: F.struct(v.isNotNull().alias("valid"), F.when(v.isNotNull(), text_of_json(v)).otherwise(F.col("line")).alias("text")))
    return rows.select(*keep, F.inline(found))


def _split_json(lines: DataFrame, min_chars: int) -> DataFrame:
    pieces = F.filter(F.transform(F.split(strip(F.col("value")), LINE_ENDS), strip), lambda x: x != "")
    n = F.when(F.contains("value", F.lit("\n")), F.size(F.filter(F.split("value", "\n"), lambda x: strip(x) != ""))).otherwise(1)
    rows = lines.select("path", "block", "at", n.alias("n"), pieces.alias("p")).select("path", "block", "at", "n", F.size("p").alias("pieces"), F.posexplode("p").alias("part", "line"))
    long = F.col("text").isNotNull() & (F.length("text") >= min_chars)
    # the text of a file's line that is one JSON value is the same either way, unless that is an array
    sure = F.endswith(F.lower("path"), F.lit(".jsonl")) | (F.col("valid") & (F.col("pieces") == 1))
    # a line is a record of its own in lines files and in files of several lines
    in_lines = F.endswith(F.lower("path"), F.lit(".jsonl")) | (F.col("lines") > 1)
    seen = _parsed(rows.withColumn("opens", F.startswith("line", F.lit("["))), "path", "n", "pieces", "part", "opens")
    sums = seen.groupBy("path").agg(F.sum(F.when(F.col("part") == 0, F.col("n"))).alias("lines"), F.count_if(long).alias("texts"), F.count_if(long & ~sure).alias("unsure"), F.count("*").alias("parts"), F.bool_or("opens").alias("opens"))
    shared_folder(lines.sparkSession)
    files = sums.select(F.col("path").alias("of"), (in_lines & (F.col("texts") > 0)).alias("by_line"), "unsure", "parts", "opens").checkpoint()
    same = F.col("path") == F.col("of")
    out = ["path", "block", "at", "part", "text"]
    parts = [_parsed(rows, "path", "block", "at", "part", "pieces").where(long & sure).select(*out)]
    raw, joined = files.where("by_line AND unsure > 0"), files.where("NOT by_line AND (parts > 1 OR opens)")
    if not raw.isEmpty():
        parts.append(_parsed(rows.join(raw, same, "left_semi"), "path", "block", "at", "part", "pieces").where(long & ~sure).select(*out))
    if not joined.isEmpty():
        whole = rows.join(joined, same, "left_semi").groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "part", "line"))), lambda r: r["line"]), "\n").alias("content"), F.count("*").alias("pieces"))
        parts.append(whole.where((F.col("pieces") > 1) | F.startswith(F.col("content"), F.lit("["))).select("path", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("at"), F.posexplode(F.coalesce(_whole_json(F.col("content"), min_chars), F.array().cast("array<string>"))).alias("part", "text")))
    return reduce(DataFrame.unionByName, parts)


def scan(table: DataFrame, text: str = "text", min_chars: int = 1, partitions: tuple[str, list[str]] | None = None) -> DataFrame:
    """Rows with enough text, of the named partitions: predicates that reach the files."""
    rows = table.where(F.length(text) >= min_chars)
    return rows.where(F.col(partitions[0]).isin(partitions[1])) if partitions else rows


def month_range(rows: DataFrame, year: int, first: int, last: int, column: str = "published_date") -> DataFrame:
    """Rows of some months of a year by a date of text or number."""
    d = ymd_of_number(F.col(column)) if isinstance(rows.schema[column].dataType, NumericType) else ymd_of_text(F.col(column))
    return rows.where((d["year"] == year) & d["month"].between(first, last))


def shards(spark: SparkSession, path: str, prefix: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Parquet shards whose names begin with a prefix, in name order, a slice of them (names alone reach the driver)."""
    names = sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").where(F.element_at(F.split("path", "/"), -1).startswith(prefix)).collect())
    return spark.read.parquet(*names[start:end])


def facts(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of (prompt, phrase, year); an empty one, or a row without a key, is an error."""
    rows = spark.read.json(path, multiLine=True, schema="prompt string, phrase string, year int")
    n, bad = rows.agg(F.count("*"), F.count_if(F.col("prompt").isNull() | F.col("phrase").isNull() | F.col("year").isNull())).first()
    if not n or bad:
        raise ValueError(f"{n} facts, {bad} incomplete: {path}")
    return rows


def prompt_bank(spark: SparkSession, path: str) -> DataFrame:
    """(prompt, category) of a list, or of an object's ``prompts`` or ``questions``; plain strings have category unknown."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value").alias("v"))
    inner = F.coalesce(F.get_json_object("v", "$.prompts"), F.get_json_object("v", "$.questions"))
    items = whole.select(F.explode(F.from_json(F.when(F.startswith(F.ltrim("v"), F.lit("[")), F.col("v")).otherwise(inner), "array<string>")).alias("i"))
    return items.select(F.when(F.startswith(F.ltrim("i"), F.lit("{")), F.get_json_object("i", "$.prompt")).otherwise(F.col("i")).alias("prompt"), F.coalesce(F.get_json_object(F.when(F.startswith(F.ltrim("i"), F.lit("{")), F.col("i")), "$.category"), F.lit("unknown")).alias("category"))


def benchmark_path(folder: str, year: int, known: bool) -> str:
    return f"{folder}/{year}/{'known' if known else 'unknown'}.json"


def benchmark_folder(spark: SparkSession, folder: str, years: list[int]) -> DataFrame:
    """(year, kind, prompt, phrase, fact_year, weight) of the files <year>/known.json and <year>/unknown.json, each with a list ``items``.

    A missing file is an error, and so is a side without items.
    """
    paths = {benchmark_path(folder, y, known): (y, "known" if known else "unknown") for y in years for known in (False, True)}
    for p in paths:
        fs, path = file_system(spark, p)
        if not fs.exists(path):
            raise FileNotFoundError(p)
    rows = spark.read.json(list(paths), multiLine=True, schema="items array<struct<prompt:string,phrase:string,year:int,weight:int>>").select(F.col("_metadata.file_path").alias("p"), F.inline("items"))
    part = lambda k: F.regexp_extract("p", r"/(\d+)/(known|unknown)\.json$", k)
    sides = rows.select(part(1).cast("int").alias("year"), part(2).alias("kind"), "prompt", "phrase", F.col("year").alias("fact_year"), F.coalesce("weight", F.lit(1)).alias("weight"))
    return checked_benchmarks(sides, years)


def parsed_lines(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON lines as (…fields, _state): kept, bad (not JSON; all fields NULL) or blank; no line is lost."""
    blank = strip(F.coalesce(column, F.lit(""))) == ""
    row = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    state = F.when(blank, "blank").when(is_json(F.col(column)), "kept").otherwise("bad")
    return lines.select(F.when(state == "kept", row).alias("_row"), state.alias("_state")).select("_row.*", "_state")


def counted(rows: DataFrame, states: Column, keep: str = "kept", **also: Column) -> tuple[DataFrame, Observation]:
    """(the rows in state ``keep``, counters of all): scanned, and how many are in each state seen on the way, without a pass of their own.

    The counters are there once an action has run. ``also`` adds aggregates under names of their own.
    """
    seen = Observation()
    of = lambda s: F.count_if(states == s)
    observed = rows.observe(seen, F.count(F.lit(1)).alias("scanned"), of("kept").alias("kept"), of("bad").alias("bad"), of("blank").alias("blank"), of("skipped").alias("skipped"), *(c.alias(k) for k, c in also.items()))
    return observed.where(states == keep), seen
