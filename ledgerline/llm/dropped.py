"""Rows of stored files marked as dropped, so that a table is filtered where it is read and none of its columns is shuffled.

A row is known by its file and its number in the file. The dropped numbers of a file become one bitmap, kept beside
the table in the shared folder, and a task that reads a part of the file reads its bitmap too.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pass, open_folder, unused
from ledgerline.session import shared_dir

# of a row in a table that is read straight from Parquet: the hash of the file's path, and the number of the row
PLACE = "named_struct('file', xxhash64(_metadata.file_path), 'row', _metadata.row_index)"


def stored(rows: DataFrame) -> DataFrame:
    """The same rows read straight from Parquet; a frame of another kind is stored in the shared folder first."""
    try:
        rows.select("_metadata.row_index")
        return rows
    except AnalysisException:
        path = f"{shared_dir(rows.sparkSession)}/rows-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_bitmaps(places: DataFrame, folder: str) -> int:
    """Store the bitmap of each file that has places (file, row); returns how many files those are.

    A task holds one bitmap: an eighth of a byte for each row of a file. Writing it again gives the same file.
    """

    def step(batches):
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        held, current, count = [], None, 0

        def close():
            rows = np.concatenate(held)
            bits = np.zeros(int(rows.max()) + 1, dtype=bool)
            bits[rows] = True
            with files.open_output_stream(f"{base}/{current}.bits") as out:
                out.write(np.packbits(bits).tobytes())

        for batch in batches:
            names, rows = batch["file"].to_numpy(), batch["row"].to_numpy()
            cuts = np.flatnonzero(np.diff(names)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)]):
                if hi > lo:
                    if names[lo] != current:
                        if held:
                            close()
                        held, current, count = [], int(names[lo]), count + 1
                    held.append(rows[lo:hi])
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count])], names=["files"])

    dealt = places.repartition("file").sortWithinPartitions("file")
    return arrow_pass(dealt, step, "files long").agg(F.sum("files")).first()[0] or 0


def without_dropped(rows: DataFrame, folder: str) -> DataFrame:
    """The rows of a table, read straight from Parquet, that no bitmap in the folder marks."""
    name = unused(rows, "_place")
    read = rows.selectExpr("*", f"{PLACE} AS {name}")

    def step(batches):
        files, base = open_folder(folder)
        current, bits = None, np.zeros(0, dtype=bool)
        for batch in batches:
            names, places = batch[name].field("file").to_numpy(), batch[name].field("row").to_numpy()
            gone = np.zeros(len(places), dtype=bool)
            for file in np.unique(names).tolist():
                if file != current:
                    path = f"{base}/{file}.bits"
                    current, raw = file, b""
                    if files.get_file_info(path).is_file:
                        with files.open_input_stream(path) as source:
                            raw = source.read()
                    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).astype(bool)
                own = np.flatnonzero(names == file)
                inside = own[places[own] < len(bits)]
                gone[inside] = bits[places[inside]]
            yield batch.drop_columns([name]).filter(pa.array(~gone))

    return arrow_pass(read, step, rows.schema)
