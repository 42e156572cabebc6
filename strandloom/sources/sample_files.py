"""A sink for one compressed text file a sample, with lines in a given order: written whole or not at all.

Rows are dealt by sample and sorted within it; a task writes its samples' files under names of its own in a folder
beside the results. Only when all tasks have ended are the files given their names; where one fails, or the job is
given up, the folder goes and no result is seen. A task that is run again writes other names.
"""

from __future__ import annotations

import gzip
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..staging import importable

SCHEMA = "sample string, value string"


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (name of its own, name of the result)."""

    files: list[tuple[str, str]] = field(default_factory=list)


class SampleFilesWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.suffix, self.header = options["path"].removeprefix("file:"), options.get("suffix", ".txt.gz"), options.get("header")
        self.overwrite = overwrite
        self.writing = os.path.join(self.folder, f"_writing-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator) -> Written:
        done, out, now = Written(), None, None
        try:
            for row in iterator:
                if out is None or row.sample != now:
                    if out is not None:
                        out.close()
                    now = row.sample
                    if not now or "/" in now or now.startswith("_"):
                        raise ValueError(f"a sample's name makes no file: {now!r}")
                    os.makedirs(self.writing, exist_ok=True)
                    own = os.path.join(self.writing, uuid.uuid4().hex)
                    out = gzip.GzipFile(own, "wb", mtime=0)
                    done.files.append((own, os.path.join(self.folder, now + self.suffix)))
                    if self.header:
                        out.write(self.header.encode() + b"\n")
                out.write((row.value or "").encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list) -> None:
        files = [x for m in messages if m for x in m.files]
        names = [name for _, name in files]
        taken = sorted({n for n in names if names.count(n) > 1 or (not self.overwrite and os.path.exists(n))}) if len(set(names)) < len(names) or not self.overwrite else []
        if taken:
            self.abort(messages)
            raise ValueError(f"written twice, or there before: {taken[:3]}")
        os.makedirs(self.folder, exist_ok=True)
        for own, name in files:
            os.replace(own, name)
        shutil.rmtree(self.writing, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.writing, ignore_errors=True)


class SampleFiles(DataSource):
    """Options: path (a folder that driver and executors share), suffix, header (first line of each file)."""

    @classmethod
    def name(cls) -> str:
        return "samplefiles"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return SampleFilesWriter(self.options, overwrite)


def write_samples(rows: DataFrame, path: str, sample: str, value: str, order: list[str], header: str | None = None, overwrite: bool = False) -> None:
    """Write value as the lines of one file for each sample, in the order of the columns named; a null value is an empty line.

    A sample is one task, which writes it as a stream.
    """
    spark = rows.sparkSession
    importable(spark)
    spark.dataSource.register(SampleFiles)
    dealt = rows.repartition(F.col(sample)).sortWithinPartitions(sample, *order).select(F.col(sample).cast("string").alias("sample"), F.col(value).alias("value"))
    out = dealt.write.format("samplefiles").mode("overwrite" if overwrite else "append")
    (out.option("header", header) if header else out).save(path)
