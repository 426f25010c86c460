"""Sources: JSON lines with line numbers, sectioned Markdown, HTML pages, page texts, logs, resumable caches (SRC)."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..functions.keys import slugify


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error) or "Path does not exist" in str(error)


def read_optional(spark: SparkSession, path: str, schema: StructType | str, how: Callable[[str], DataFrame]) -> DataFrame:
    """how(path), or an empty table of the schema where nothing is there (SRC02)."""
    try:
        df = how(path)
        df.schema  # noqa: B018 - the path is resolved here
        return df
    except Exception as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1 in each file), value of all lines of text files; large files are read in parts.

    Spark deals a file's bytes out in blocks and gives each line to one of them. A block's rows are read one after the
    other, so a line's place in it follows from row ids; lines in the blocks before it are counted in a pass of its own.
    """
    lines = "value string, path string, block long, row long"
    raw = read_optional(spark, path, lines, lambda p: spark.read.text(p).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))
    blocks = raw.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = blocks.select("path", "block", (before - F.col("first") + 1).alias("_to_line"))  # one row for each block of a file
    x = raw.join(offsets, ["path", "block"]).withColumn("line", F.col("row") + F.col("_to_line"))
    return x.select("path", "line", F.when(F.col("line") == 1, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")).alias("value"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with `line`, errors with path, line and problem): blank lines are skipped, a missing path is empty (SRC01)."""
    x = numbered_lines(spark, path).select("path", "line", F.trim("value").alias("s")).where("s <> ''")
    fine = F.expr("try_parse_json(s)").isNotNull()
    problem = F.when(~fine, "invalid JSON").when(~F.col("s").startswith("{"), "not an object")
    rows = x.where(problem.isNull()).select("line", F.from_json("s", schema).alias("r")).select("line", "r.*")
    return rows, x.where(problem.isNotNull()).select("path", "line", problem.alias("problem"))


def markdown_paths(spark: SparkSession, root: str) -> DataFrame:
    """path, value of every *.md under root but readmes and templates, by path (SRC03, SRC06)."""
    x = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(root, wholetext=True).select(F.input_file_name().alias("path"), F.regexp_replace("value", "^\ufeff", "").alias("value"))
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    return x.where((name != "readme.md") & ~F.regexp_replace(name, r"\.md$", "").contains("template")).orderBy("path")


def front_matter(text: str | None) -> tuple[dict[str, list[str]] | None, str, str | None]:
    """(fields, the rest, error): `key: value` and `- item` lines between --- fences; all values as lists (SRC04)."""
    lines = (text or "").splitlines()
    if not lines or lines[0].strip() != "---":
        return {}, text or "", None
    fields: dict[str, list[str]] = {}
    key = None
    for i, line in enumerate(lines[1:], 1):
        s = line.strip()
        if s == "---":
            return fields, "\n".join(lines[i + 1 :]), None
        if s.startswith("- ") and key is not None:
            fields[key].append(re.sub(r"^(['\"])(.*)\1$", r"\2", s[2:].strip()))
        elif ":" in s:
            key, value = (x.strip() for x in s.split(":", 1))
            fields[key] = [re.sub(r"^(['\"])(.*)\1$", r"\2", value)] if value else []
    return None, "", "front matter is not closed"


_BREAK = re.compile(T.LINE_BREAK)
_HEADING = re.compile(r"(?m)^# (.*)$")


def sections_of(text: str | None, aliases: dict[str, str]) -> dict[str, str]:
    """name -> body of the parts under `# ` headings, as `sections` gives them."""
    parts = _HEADING.split("\n".join(_BREAK.split(text or "")))[1:]  # title, rest, title, rest ...
    found: dict[str, list[str]] = {}
    for title, rest in zip(parts[::2], parts[1::2]):
        title = title.strip().lower()
        # The rest begins with the heading's own line break; without one, or with nothing after it, no line follows.
        found.setdefault(aliases.get(title) or slugify(title), []).extend(rest.removesuffix("\n").split("\n")[1:])
    return {name: "\n".join(lines).strip() for name, lines in found.items()}


def sections(text: Column, aliases: dict[str, str]) -> Column:
    """map<name, body> of the parts under headings, lines that begin with `# ` (SRC05).

    A part's name is the alias of its lower-cased title, else the title's slug (letters of other scripts that decompose to
    none give `untitled`). Lines under equal names follow one another, and a body is trimmed once, as a whole.
    """

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: sections_of(t, aliases))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "map<string, string>")(text)


def bullets(text: Column) -> Column:
    """What stands after `- ` in the lines that begin so, trimmed."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), T.LINE_BREAK), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.transform(F.filter(trimmed, lambda x: x.startswith("- ")), lambda x: F.regexp_replace(F.substr(x, F.lit(3)), r"(?U)^\s+|\s+$", ""))


def bullet_map(text: Column) -> Column:
    """map of `- key: value`, `- question? value` and bare `- key` lines; keys in lower case, the last one wins (SRC07).

    The first colon parts a line; only a line without one is parted at its first question mark, if a blank follows one.
    """

    def pair(x):
        colon, asks = F.contains(x, F.lit(":")), F.contains(x, F.lit("? "))
        key = F.when(colon, F.regexp_extract(x, r"(?s)^(.*?)\s*:", 1)).when(asks, F.concat(F.regexp_extract(x, r"(?s)^(.*?)\s*\?", 1), F.lit("?"))).otherwise(x)
        value = F.when(colon, F.regexp_extract(x, r"(?s)^.*?:\s*(.*)$", 1)).when(asks, F.regexp_extract(x, r"(?s)^.*?\?\s*(.*)$", 1)).otherwise("")
        return F.struct(F.lower(key).alias("k"), value.alias("v"))

    pairs = F.transform(bullets(text), pair)
    keys = F.array_distinct(F.transform(pairs, lambda x: x["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda x: x["k"] == k), -1)["v"]))


def bullet_values(text: Column) -> Column:
    """What stands before a colon in each bullet, if anything does (SRC08)."""
    return F.filter(F.transform(bullets(text), lambda x: F.rtrim(F.substring_index(x, ":", 1))), lambda x: x != "")


def theme_values(text: Column) -> Column:
    """Whole bullets but unfilled slots, which begin with a bracket (SRC10)."""
    return F.filter(bullets(text), lambda x: (x != "") & ~x.startswith("["))


def key_terms(text: Column) -> Column:
    """array<struct<headword, meaning, do_not_flatten_to>> of `- head: meaning; do_not_flatten_to x, y.` bullets (SRC09).

    Bullets without a colon, a headword or a meaning, and unfilled slots (in brackets) are no terms.
    """
    clause = r"(?is)[;\s]*\bdo[ _]not[ _]flatten[ _]to:?\s*(.*?)\.?\s*$"

    def term(x):
        meaning = F.regexp_replace(x, r"(?s)^[^:]*:\s*", "")
        avoid = F.transform(F.split(F.regexp_extract(meaning, clause, 1), ","), lambda t: F.trim(t))
        return F.struct(F.trim(F.substring_index(x, ":", 1)).alias("headword"), F.trim(F.regexp_replace(meaning, clause, "")).alias("meaning"), F.filter(avoid, lambda t: t != "").alias("do_not_flatten_to"))

    told = F.filter(bullets(text), lambda x: x.rlike(r"^\s*[^:\[\s][^:]*:\s*\S"))
    return F.transform(told, term)


#: Characters of elements that a task holds before they go on, and what an element counts besides its own.
PIECE, ELEMENT = 1_000_000, 50


class _Links(HTMLParser):
    """Links with their text, headings, and texts of elements that carry a data id (SRC11-SRC14)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str | None, str]] = []
        self.open: list[tuple[str, str | None, list[str]]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("a", "h1", "h2", "h3", "title", "p") or "data-id" in a:
            self.open.append((tag, a.get("href") or a.get("data-id"), []))

    def handle_data(self, data):
        for x in self.open:
            x[2].append(data)

    def handle_endtag(self, tag):
        if any(t == tag for t, _, _ in self.open):
            while self.open:
                t, ref, said = self.open.pop()
                self.rows.append((t, ref, " ".join("".join(said).split())))
                if t == tag:
                    break


def html_elements(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, pos, tag, ref, text for the links, headings and paragraphs of every page; a bad page gives none.

    Pages are read one by one from Arrow, and their elements go on whenever they come to PIECE characters.
    """

    def run(batches):
        for b in batches:
            out, held = [], 0
            for k, html in zip(b.column(0), b.column(1)):
                p = _Links()
                p.feed(html.as_py() or "")
                p.close()
                for i, row in enumerate(p.rows):
                    out.append((k.as_py(), i, *row))
                    held += ELEMENT + len(row[1] or "") + len(row[2])
                    if held >= PIECE:
                        yield _element_batch(out, key)
                        out, held = [], 0
            if out:
                yield _element_batch(out, key)

    return pages.select(F.col(key).cast("long"), "html").mapInArrow(run, f"{key} long, pos int, tag string, ref string, text string")


def _element_batch(rows: list[tuple], key: str) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [key, "pos", "tag", "ref", "text"])


def catalog(elements: DataFrame, key: str = "page_id") -> DataFrame:
    """key, title, n_links, problem: the page's first heading; a page without one is a status, no exception (SRC15)."""
    title = F.min_by("text", F.when(F.col("tag").isin("h1", "title"), F.col("pos")))
    return elements.groupBy(key).agg(title.alias("title"), F.count_if(F.col("tag") == "a").alias("n_links")).withColumn("problem", F.when(F.col("title").isNull(), "no heading"))


def first_urls(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per content_id, the first seen; content_ids with several urls) of discovered items (SRC19, SRC20)."""
    w = Window.partitionBy("content_id").orderBy("seq")
    rows = found.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return rows, found.groupBy("content_id").agg(F.countDistinct("url").alias("urls")).where("urls > 1")


def fetch(items: DataFrame, get: Callable[[str], str], tries: int = 3, pause: float = 0.0, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """items (url) with `html` and `failed`: an injected get, retried with doubled pauses (SRC16, SRC17)."""
    names = items.columns

    def run(frames):
        for f in frames:
            html, failed = [], []
            for url in f["url"]:
                said, why = None, None
                for n in range(tries):
                    try:
                        said, why = get(url), None
                        break
                    except Exception as e:  # noqa: BLE001 - a failed fetch is data
                        why = f"{type(e).__name__}: {e}"[:200]
                        wait(pause * 2**n)
                html.append(said)
                failed.append(why)
            yield f[names].assign(html=html, failed=failed)

    kinds = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in items.schema.fields)
    return items.mapInPandas(run, f"{kinds}, html string, failed string")


def through_cache(items: DataFrame, cache: DataFrame, get: Callable[[str], str], keys: list[str]) -> DataFrame:
    """Cached pages, and fetched ones for the misses (SRC18, SRC26)."""
    misses = fetch(items.join(cache, keys, "left_anti"), get).select(*cache.columns)
    return cache.join(items, keys, "left_semi").unionByName(misses)


def segments(page_texts: DataFrame, heading: str = r"^\s*(\d{1,3})\.\s*(.*\S)\s*$", footer: str | None = None, key: str | None = None) -> DataFrame:
    """ordinal, title, page_start, page_end, text of numbered sections that run over pages (SRC22, WIN07).

    page_texts: page, text (and key: several books). Lines before the first heading are left out; a section ends on
    the last page where it has something.
    """
    book = [key] if key else []
    kept = F.filter(F.split("text", "\n"), lambda s: F.trim(s) != F.lit(footer)) if footer else F.split("text", "\n")
    pages = page_texts.select(*book, "page", kept.alias("lines"))
    # Headings are numbered over the pages, of which only the counts are sorted, and then inside each page.
    heads = pages.groupBy(*book, "page").agg(F.sum(F.size(F.filter("lines", lambda s: s.rlike(heading)))).alias("n"))
    order = (Window.partitionBy(key) if key else Window.partitionBy(F.lit(1))).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*book, "page", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    x = pages.join(heads, [*book, "page"]).select(*book, "page", "before", F.posexplode("lines").alias("line", "s"))
    own = Window.partitionBy(*book, "page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    head = F.col("s").rlike(heading)
    x = x.withColumn("head", head).withColumn("g", F.col("before") + F.sum(head.cast("int")).over(own)).where("g > 0")
    keys = ([key] if key else []) + ["g"]
    said = F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("page", "line", "s"))))
    return x.groupBy(*keys).agg(
        F.max(F.when(F.col("head"), F.regexp_extract("s", heading, 1).cast("int"))).alias("ordinal"), F.max(F.when(F.col("head"), F.regexp_extract("s", heading, 2))).alias("title"),
        F.min("page").alias("page_start"), F.max(F.when(F.trim("s") != "", F.col("page"))).alias("page_end"), T.trim_blank_edges(F.array_join(F.transform(said, lambda v: v["s"]), "\n")).alias("text"),
    )


def mode_blocks(lines: DataFrame, markers: dict[str, str]) -> DataFrame:
    """seq, mode, s: each line under the last marker line before it (SRC23)."""
    mode = F.create_map(*[F.lit(x) for kv in markers.items() for x in kv])
    found = F.try_element_at(mode, F.upper(F.trim("s")))
    w = Window.partitionBy("doc").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("m", found).withColumn("mode", F.last("m", True).over(w)).where("m is null").drop("m")


def training_log(lines: DataFrame) -> DataFrame:
    """iter, kind, loss from log lines such as `Iter 25: Val loss 1.3` (SRC24)."""
    it, kind, loss = (F.regexp_extract("value", r"Iter (\d+):.*?(Val|Train) loss ([0-9.]+)", i) for i in (1, 2, 3))
    return lines.select(it.try_cast("int").alias("iter"), F.lower(kind).alias("kind"), F.rtrim(loss, F.lit(".")).try_cast("double").alias("loss")).where("iter is not null")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run summaries, one JSON document each; none where the path is missing (SRC25)."""
    kinds = "model string, rag boolean, probes int, factual double, honesty double, judge string, judge_failures int, answer_failures int"
    return read_optional(spark, path, kinds, lambda p: spark.read.schema(kinds).json(p, multiLine=True))


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim("value").alias("question"))


def pdf_pages(files: DataFrame, extract: Callable[[bytes], list[str]]) -> DataFrame:
    """path, page, text from binary files by an injected text extractor (SRC21)."""

    def run(frames):
        for f in frames:
            yield pd.DataFrame([(p, i, t) for p, c in zip(f["path"], f["content"]) for i, t in enumerate(extract(bytes(c)), 1)], columns=["path", "page", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, page int, text string")


def entry_ids(title: str) -> str:
    return slugify(title)
