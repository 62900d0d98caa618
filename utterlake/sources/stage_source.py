"""A data source for stage files: streamed, so that a file of any size needs the memory of a segment; names that begin with _ are found."""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable, Iterator
from urllib.parse import quote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from utterlake.sources.files import ARRAYS, DEFAULTS, SEGMENT

HEAD = ("version", "n_raw", "audio_duration")
SCHEMA = f"recording_id string, seq bigint, {SEGMENT}, version string, n_raw bigint, audio_duration double, error string"
WORD_FIELDS = (("word", "string"), ("start", "double"), ("end", "double"), ("score", "double"), ("speaker", "string"))
SPACE, NUMBER = " \t\r\n", frozenset("0123456789.eE+-")
#: Characters after which a value that still doesn't end makes a file unreadable: a broken one is not read whole.
LARGEST = 1 << 28


class JsonStream:
    """Members of a JSON object, read piece by piece: a member that is an array comes element by element."""

    def __init__(self, read: Callable[[int], bytes], step: int = 1 << 16) -> None:
        self.read, self.step, self.decode = read, step, codecs.getincrementaldecoder("utf-8")().decode
        self.text, self.at, self.ended, self.largest = "", 0, False, 0

    def _more(self, size: int) -> None:
        got = self.read(size)
        self.ended = not got
        self.text, self.at = self.text[self.at :] + self.decode(got, final=self.ended), 0
        self.largest = max(self.largest, len(self.text))

    def _peek(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in SPACE:
                self.at += 1
            if self.at < len(self.text) or self.ended:
                return self.text[self.at : self.at + 1]
            self._more(self.step)

    def _take(self, wanted: str) -> str:
        got = self._peek()
        if not got or got not in wanted:
            raise ValueError(f"{got!r} instead of one of {wanted!r}")
        self.at += 1
        return got

    def _value(self):
        """One whole value; it may go on where the text ends, so that more is read, twice as much each time."""
        self._peek()
        size = self.step
        while True:
            try:
                value, end = json.JSONDecoder().raw_decode(self.text, self.at)
                if self.ended or (end < len(self.text) and self.text[end] not in NUMBER):
                    self.at = end
                    return value
            except ValueError:
                if self.ended or len(self.text) - self.at > LARGEST:
                    raise
            self._more(size)
            size *= 2

    def members(self) -> Iterator[tuple[str, bool, object]]:
        """(name, whether it is an element of an array, value); an array itself comes first, as (name, True, ...)."""
        self._take("{")
        more = self._peek() != "}"
        if not more:
            self._take("}")
        while more:
            name = self._value()
            if not isinstance(name, str):
                raise ValueError("a name that is no string")
            self._take(":")
            if self._peek() == "[":
                self._take("[")
                yield name, True, ...
                open_ = self._peek() != "]"
                if not open_:
                    self._take("]")
                while open_:
                    yield name, True, self._value()
                    open_ = self._take(",]") == ","
            else:
                yield name, False, self._value()
            more = self._take(",}") == ","
        if self._peek():
            raise ValueError("text after the object")


def _typed(value, kind: str):
    """A JSON value as a column's value; ValueError where it is none."""
    if value is None:
        return None
    if kind == "string":
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if kind == "double" and value in ("NaN", "Infinity", "-Infinity"):
        return float(value)
    fits = {"double": (int, float), "bigint": (int,), "boolean": (bool,)}[kind]
    if not isinstance(value, fits) or (kind != "boolean" and isinstance(value, bool)):
        raise ValueError(f"{value!r} is no {kind}")
    return float(value) if kind == "double" else value


def _segment(told) -> tuple:
    told = {} if told is None else told
    if not isinstance(told, dict):
        raise ValueError("a segment that is no object")
    out = []
    for name, kind in (c.split(" ", 1) for c in SEGMENT.split(", ")):
        if name != "words":
            value = _typed(told.get(name), kind)
            out.append(DEFAULTS.get(name) if value is None else value)
        else:
            words = told.get(name)
            if not (words is None or (isinstance(words, list) and all(w is None or isinstance(w, dict) for w in words))):
                raise ValueError("words that are no list of objects")
            out.append(words if words is None else [w if w is None else tuple(_typed(w.get(n), k) for n, k in WORD_FIELDS) for w in words])
    return tuple(out)


def head_of(stream: JsonStream, array: str) -> tuple:
    """version, n_raw, audio_duration of a whole file, all of whose segments have been looked at; ValueError if it can't be read."""
    head, there = dict.fromkeys(HEAD), False
    for name, element, value in stream.members():
        if name == array:
            if not element:
                raise ValueError(f"{array} is no array")
            there = True
            if value is not ...:
                _segment(value)
        elif name in head and not element:
            head[name] = _typed(value, {"version": "string", "n_raw": "bigint", "audio_duration": "double"}[name])
    if not there:
        raise ValueError(f"no {array}")
    return tuple(head.values())


class Files(InputPartition):
    def __init__(self, files: list[tuple[str, str]]) -> None:
        self.files = files


class StageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.stage, self.suffix = options["path"], int(options.get("stage", 2)), options.get("suffix", ".json")
        self.most, self.files = int(options.get("bytes", 64 << 20)), int(options.get("files", 256))

    def _system(self):
        return fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), self.root)

    def partitions(self) -> list[Files]:
        """Each large file on its own, small ones together up to `bytes` and `files`."""
        system, root = self._system()
        scheme = urlsplit(self.root).scheme if "://" in self.root else "file"
        found = [f for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and f.path.endswith(self.suffix)]
        parts, size = [], 0
        for f in sorted(found, key=lambda f: f.path):
            if not parts or size + f.size > self.most or len(parts[-1].files) >= self.files:
                parts.append(Files([]))
                size = 0
            size += f.size
            # the same name as input_file_name() gives
            parts[-1].files.append((f"{scheme}://{quote(f.path, safe="/!$&'()*+,;=:@~")}", f.path))
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        system, array = self._system()[0], ARRAYS[self.stage]
        fields = len(SEGMENT.split(", "))
        for name, path in partition.files:
            try:
                with system.open_input_stream(path) as f:
                    head = head_of(JsonStream(f.read), array)
            except (ValueError, RecursionError) as e:  # not what the file system says: that is tried again as a task
                yield (name, None, *[None] * fields, *[None] * len(HEAD), str(e)[:200] or type(e).__name__)
                continue
            with system.open_input_stream(path) as f:
                told = (v for n, _, v in JsonStream(f.read).members() if n == array and v is not ...)
                for seq, segment in enumerate(told):
                    yield (name, seq, *_segment(segment), *head, None)


class StageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stage_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> StageReader:
        return StageReader(dict(self.options))


def stream_stage_files(spark: SparkSession, root: str, stage: int, **options) -> DataFrame:
    """The segments of all stage files below root, as read_stage_json() gives them, with n_raw, audio_duration and error.

    A file is read twice, first to see whether it is whole: one that can't be read is one row with its error and no segment. An
    empty segment list gives no row. An array's elements come one at a time, so that memory is that of the largest one. options:
    suffix (.json), bytes and files of a task. Root is listed on the driver, as Spark's file sources do; its file system must be one that Arrow can open.
    """
    spark.dataSource.register(StageSource)
    reader = spark.read.format("stage_files").option("stage", stage)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(root)
