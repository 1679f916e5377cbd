"""Large JSON array files, read in ranges by many tasks.

Spark's text reader cuts a file into ranges and each range into records at commas, wherever these stand. Records are
joined to chunks again, and each chunk tells how many quotes it has and how its brackets change the depth if it
begins outside or inside of a string. Running sums of that over a file's chunks say how each one really begins. A file
begins outside of a string at depth 0, and its later ranges mostly begin as their first chunk looks, so that chunks are
cut at the commas of the outermost array in the same reading; ranges of which the sums say otherwise are read and cut again.
Only the pieces at chunks' ends meet in a shuffle, where they are joined to items. Python holds two chunks and one
Arrow batch of records at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written

CHUNK_BYTES = 1 << 20
END_MARK = "end of the item"
FILE = ["file_a", "file_b"]  # two hashes of the path stand for it, so that records stay short
CHUNK = [*FILE, "start", "seq"]
TOLD = ["bytes", "quotes", "outside", "inside", "in_text", "depth", "last"]
BROKEN, TOLD_ROW = -1, -2  # places of rows that are no pieces
SPACES = r"^[ \t\r\n]*$"
OBJECT = r"^[ \t\r\n]*\{"
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"


def _file_keys() -> list[Column]:
    # The same for every reader, but not written as in _metadata.
    path = F.input_file_name()
    return [F.xxhash64(path).alias(FILE[0]), F.xxhash64(path, F.lit(1)).alias(FILE[1])]


def _chosen(files: DataFrame, path_part: str | None, above: int) -> DataFrame:
    # Fields of _metadata are added to every record, and an empty file has none.
    files = files.where(F.col("_metadata.file_size") > above) if above > 0 else files
    return files.where(F.col("_metadata.file_path").contains(path_part)) if path_part else files


def large_files(spark: SparkSession, path: str, name_glob: str, path_part: str | None, above: int) -> DataFrame:
    """(path, size, file_a, file_b) of the files of more than ``above`` bytes; their content is not read."""
    files = spark.read.format("binaryFile").load(path, recursiveFileLookup=True, pathGlobFilter=name_glob)
    files = _chosen(files, path_part, above)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), *_file_keys())


def _chunker(chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[tuple, bytes]]]:
    """From records in the order of the file to ((file_a, file_b, start, seq), bytes); a comma follows each record."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
        key, seq, held, size = None, 0, [], 0
        for batch in batches:
            ids = [batch.column(k).to_numpy() for k in range(3)]
            values = batch.column(3)
            changed = np.any([np.diff(x) != 0 for x in ids], axis=0)
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                here = tuple(int(x[lo]) for x in ids)
                if here != key:
                    if held:
                        yield (*key, seq), b",".join(held) + b","
                    key, seq, held, size = here, 0, [], 0
                part = values.slice(lo, hi - lo)
                ends = np.cumsum(pc.binary_length(part).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
                stops, done = [0], -size
                while (stop := int(np.searchsorted(ends, done + chunk_bytes)) + 1) <= len(part):
                    stops.append(stop)
                    done = int(ends[stop - 1])
                full = len(stops) - 1
                if stops[-1] < len(part):
                    stops.append(len(part))
                lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), part)
                for k, text in enumerate(pc.binary_join(lists, b",").to_pylist()):
                    held.append(text)
                    if k < full:
                        yield (*key, seq), b",".join(held) + b","
                        seq, held = seq + 1, []
                size = int(ends[-1]) - done if full < len(stops) - 1 else 0
        if held:
            yield (*key, seq), b",".join(held) + b","

    return chunks


def _structure() -> tuple[Callable, np.ndarray]:
    """The function that finds the brackets and commas of some bytes, and each byte's change of the depth."""
    marked, step = np.zeros(256, bool), np.zeros(256, np.int64)
    marked[list(b'"[]{},')] = True
    step[list(b"[{")], step[list(b"]}")] = 1, -1

    def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Places, bytes and quotes before each, and the number of quotes; a quote behind an odd run of backslashes is none."""
        at = np.flatnonzero(marked[data])
        byte = data[at]
        quote = byte == ord('"')
        slashes = np.flatnonzero(data == ord("\\"))
        if len(slashes):
            places = at[quote]
            fresh = np.r_[True, np.diff(slashes) != 1]
            begins = slashes[fresh][np.cumsum(fresh) - 1]
            near = np.minimum(np.searchsorted(slashes, places - 1), len(slashes) - 1)
            run = np.where(slashes[near] == places - 1, places - begins[near], 0)
            quote[np.flatnonzero(quote)] = run % 2 == 0
        before, rest = np.cumsum(quote), byte != ord('"')
        return at[rest], byte[rest], before[rest], int(quote.sum())

    return structure, step


def _states(told: DataFrame) -> DataFrame:
    """How each chunk begins: inside a string or not, depth, whether it is the file's last one; ``wrong`` if it was cut as beginning otherwise."""
    ordered = Window.partitionBy(*FILE).orderBy("start", "seq")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    cut_as = told.withColumnsRenamed({n: f"cut_{n}" for n in TOLD[4:]})
    in_text = cut_as.withColumn("in_text", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    step = F.when(F.col("in_text") == 0, F.col("outside")).otherwise(F.col("inside"))
    stepped = in_text.withColumn("step", step).withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    lasts = stepped.withColumn("last", F.lead(F.lit(0), 1, 1).over(ordered).cast("long"))
    wrong = (F.col("in_text") != F.col("cut_in_text")) | (F.col("depth") != F.col("cut_depth")) | (F.col("last") != F.col("cut_last"))
    return lasts.select(*CHUNK, "bytes", "quotes", "step", "in_text", "depth", "last", wrong.alias("wrong"))


def _wrong_starts(states: DataFrame) -> DataFrame:
    """Ranges that were cut as beginning otherwise than they do: how they begin, and whether the file ends with them."""
    starts = states.groupBy(*FILE, "start").agg(
        F.min_by("in_text", "seq").alias("in_text"), F.min_by("depth", "seq").alias("depth"), F.max("last").alias("ends"), F.max("wrong").alias("wrong")
    )
    return starts.where("wrong").drop("wrong")


def _pieces(records: DataFrame, chunk_bytes: int, starts: DataFrame | None = None) -> DataFrame:
    """(chunk, commas, place, piece): a chunk's pieces between commas of the outermost array, and a row of what it tells.

    A chunk that breaks the form of a single array has a place of ``BROKEN``. Without ``starts`` it is guessed how a
    range begins that is not its file's first; with them only their ranges are cut.
    """
    chunks, (structure, step), given = _chunker(chunk_bytes), _structure(), starts is not None
    space = b" \t\r\n"

    def guess(data: bytes, at, byte, before, final: bool) -> tuple[int, int]:
        # Brackets stand mostly outside of strings, and a chunk mostly reaches the depth of the outermost array, or its end.
        live = max(((before + k) % 2 == 0 for k in (0, 1)), key=lambda x: np.count_nonzero(step[byte[x]]))
        depths, places = np.cumsum(step[byte[live]]), at[live][step[byte[live]] != 0]
        low = min(0, int(depths.min())) if len(depths) else 0
        closes = final and len(places) and depths[-1] == low < 0 and data[places[-1] :].rstrip(space + b",") == b"]"
        closes = closes and np.count_nonzero(depths[at[live] < places[-1]] == low) == 0
        return int(len(before) > 0 and not np.array_equal(live, before % 2 == 0)), -low if closes else 1 - low

    def cut(data: bytes, at, byte, steps, depth: int, first: bool) -> list[bytes] | None:
        depths = depth + np.cumsum(steps)
        opened, closed = at[(steps == 1) & (depths == 1)], at[(steps == -1) & (depths == 0)]
        if (len(depths) and depths.min() < 0) or len(opened) != int(first) or len(closed) > 1:
            return None
        if not first and depth == 0:
            return None if data.strip(space) else []
        lo, hi = int(opened[0]) + 1 if first else 0, int(closed[0]) if len(closed) else len(data)
        ends = data[hi:]
        if first and data[:lo].lstrip(space) != b"[" or len(closed) and ends.rstrip(space) != b"]":
            return None
        places = at[(byte == ord(",")) & (depths == 1) & (at >= lo) & (at < hi)].tolist()
        return [data[a:b] for a, b in zip([lo, *(p + 1 for p in places)], [*places, hi])]

    def with_final(made: Iterator[tuple[tuple, bytes]]) -> Iterator[tuple[tuple, bytes, bool]]:
        """Each chunk, and whether it is its range's last one."""
        held = None
        for key, data in made:
            if held:
                yield *held, held[0][:3] != key[:3]
            held = key, data
        if held:
            yield *held, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins: dict[tuple, tuple] = {}

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # A range's records follow each other, so its state is read where its first record is.
                ids = np.stack([batch.column(k).to_numpy() for k in range(3)])
                for k in [0, *(np.flatnonzero((np.diff(ids) != 0).any(axis=0)) + 1).tolist()] if batch.num_rows else []:
                    begins.setdefault(tuple(ids[:, k].tolist()), tuple(batch.column(c)[k].as_py() for c in range(4, 7)))
                yield batch

        def rows(key: list[int], place, piece: list[bytes], told: list[int] | None = None) -> pa.RecordBatch:
            same = [pa.array(np.full(len(piece), v, np.int64)) for v in (*key, len(piece) - 1)]
            told = [pa.array([v], pa.int64()) for v in told] if told else [pa.nulls(len(piece), pa.int64())] * len(TOLD)
            return pa.RecordBatch.from_arrays([*same, pa.array(place, pa.int64()), *told, pa.array(piece, pa.binary())], names)

        for (*file, start, seq), data, final in with_final(chunks(noted() if given else batches)):
            at, byte, before, quotes = structure(np.frombuffer(data, np.uint8))
            steps, inside = step[byte], before % 2 == 1
            told = [len(data), quotes, int(steps[~inside].sum()), int(steps[inside].sum())]
            if seq == 0 and given:
                in_text, depth, ends = begins.pop((*file, start))
            elif seq == 0:
                in_text, depth = guess(data, at, byte, before, final) if start else (0, 0)
            live = inside if in_text else ~inside
            at, byte, steps = at[live], byte[live], steps[live]
            after = depth + int(steps.sum())
            # A comma more than the file has follows its last record.
            last = final and (ends == 1 if given else after == 0)
            made = cut(data[:-1] if last else data, at, byte, steps, depth, start == seq == 0)
            yield rows([*file, start, seq], [TOLD_ROW], [b""], [*told, in_text, depth, int(last)])
            if made is None:
                yield rows([*file, start, seq], [BROKEN], [b""])
            elif made:
                yield rows([*file, start, seq], np.arange(len(made)), made)
            in_text, depth = (in_text + quotes) % 2, after

    names = [*CHUNK, "commas", "place", *TOLD, "piece"]
    if given:
        # Only a broadcast leaves a range's records in their order; there is one row for each range.
        records = records.join(F.broadcast(starts), [*FILE, "start"]).select(*FILE, "start", "value", "in_text", "depth", "ends")
    return records.mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", piece binary")


def _parsed(df: DataFrame, text: Column, numbered: bool) -> DataFrame:
    """Add whether a text is blank, one whole value, an object, and the item unless ``numbered``. A NULL text is not parsed."""
    # The parser stops at the end of a value. With a mark behind the item, text that goes on breaks the list.
    marked = F.from_json(F.concat(F.lit("["), "text", F.lit(f',["{END_MARK}"]]')), "array<variant>")
    df = df.withColumn("text", text).withColumn("blank", F.col("text").rlike(SPACES)).withColumn("parts", F.when(~F.col("blank"), marked))
    whole = (F.size("parts") == 2) & (F.try_variant_get(F.get("parts", F.lit(1)), "$[0]", "string") == END_MARK)
    # An item is kept as text, which is quicker to write and read than a variant.
    item = {} if numbered else {"item": F.to_json(F.get("parts", F.lit(0)))}
    return df.withColumns({"whole": F.coalesce(whole, F.lit(False)), "object": F.col("text").rlike(OBJECT)} | item).drop("text", "parts")


def _at_end() -> Column:
    return (F.col("place") == 0) | (F.col("place") == F.col("commas"))


def _inner_parsed(pieces: DataFrame, numbered: bool) -> DataFrame:
    """Pieces that are whole items parsed; only the others keep their bytes."""
    inner = (F.col("place") >= 0) & ~_at_end()
    parsed = _parsed(pieces, F.when(inner, F.col("piece").cast("string")), numbered)
    return parsed.withColumn("piece", F.when(~inner, F.col("piece")))


def _items_of(pieces: DataFrame, numbered: bool) -> DataFrame:
    """(file, blank, whole, object) of all items, with ``numbered`` their position, else the item."""
    sound = pieces.where("place >= 0")
    earlier = Window.partitionBy(*FILE).orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sound.where("place = 0").select(*CHUNK, "commas")
    base = chunks.select(*CHUNK, F.coalesce(F.sum("commas").over(earlier), F.lit(0)).alias("base"))
    position = (F.col("base") + F.col("place")).alias("position")
    ends = sound.where(_at_end()).join(base, CHUNK).select(*CHUNK, position, "piece")
    parts = F.array_sort(F.collect_list(F.struct("start", "seq", "piece")))
    # Bytes are joined before they become text: a chunk may only end at a comma, but stays bytes until it is whole.
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    merged = ends.groupBy(*FILE, "position").agg(joined.alias("piece"))
    columns = [*FILE, "blank", "whole", "object", "position" if numbered else "item"]
    # Parsed once; which files are broken is known only when all items are.
    merged = written(_parsed(merged, F.col("piece").cast("string"), numbered).select(columns), "array_items")
    inner = sound.where(~_at_end())
    inner = inner.join(base, CHUNK).withColumn("position", position) if numbered else inner
    return merged.unionAll(inner.select(columns))


def read_ranges(
    spark: SparkSession, path: str, name_glob: str, path_part: str | None = None, above: int = 0, chunk_bytes: int = CHUNK_BYTES, numbered: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Items (object, item) of the files of more than ``above`` bytes, with ``numbered`` (path, position, object), and (path) of those that are not one array.

    An item is the JSON text of a variant; ``object`` says whether it is an object. Files of any size are read by as many
    tasks as Spark makes ranges of them (``spark.sql.files.maxPartitionBytes``), but a text without a comma is one record.
    Records and chunks are the same in every reading, since Spark cuts a file into the same ranges each time.
    """
    # One row for each file; Spark would take the files' bytes for the size of this and shuffle items by file.
    files = F.broadcast(large_files(spark, path, name_glob, path_part, above))
    lines = spark.read.text(path, lineSep=",", recursiveFileLookup=True, pathGlobFilter=name_glob)
    lines = _chosen(lines, path_part, above)
    start = F.input_file_block_start().alias("start")
    records = lines.select(*_file_keys(), start, F.col("value").cast("binary").alias("value"))
    pieces = written(_inner_parsed(_pieces(records, chunk_bytes), numbered), "array_pieces")
    states = written(_states(pieces.where(F.col("place") == TOLD_ROW).select(*CHUNK, *TOLD)), "array_states")
    if not states.where("wrong").isEmpty():
        starts = written(_wrong_starts(states), "array_starts")
        again = written(_inner_parsed(_pieces(records, chunk_bytes, starts), numbered), "array_pieces_again")
        pieces = pieces.join(F.broadcast(starts.select(*FILE, "start")), [*FILE, "start"], "left_anti").unionAll(again)
    items = _items_of(pieces, numbered)
    counted = items.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("blanks"), F.count_if(~F.col("blank") & ~F.col("whole")).alias("wrong")
    )
    # [] is one blank piece.
    wrong = counted.where((F.col("wrong") > 0) | ((F.col("blanks") > 0) & (F.col("n") > 1))).select(*FILE)
    ended = states.groupBy(*FILE).agg(F.sum("step").alias("depth"), (F.sum("quotes") % 2).alias("in_text"), F.sum("bytes").alias("bytes"))
    # A record more than there are separators, unless the file ends with one.
    trailing = ~F.col("path").rlike(COMPRESSED) & (F.col("bytes") != F.col("size") + 1)
    unended = ended.join(files, FILE).where((F.col("depth") != 0) | (F.col("in_text") != 0) | trailing).select(*FILE)
    broken = pieces.where(F.col("place") == BROKEN).select(*FILE)
    bad = written(wrong.unionAll(unended).unionAll(broken).distinct().join(files, FILE).select(*FILE, "path"), "array_broken")
    good = items.where(~F.col("blank")).join(bad.select(*FILE), FILE, "left_anti")
    good = good.join(files, FILE).select("path", "position", "object") if numbered else good.select("object", "item")
    return good, bad.select("path")
