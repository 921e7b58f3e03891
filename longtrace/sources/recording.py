"""Binary recordings read in byte ranges: continuous samples and event packets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: A data packet's head: one flag byte (1), then timestamp and number of points, 32 bits each.
PACKET_HEAD = 9
#: Packet ids of spikes, and the bytes of their payload that tell the class.
SPIKE_IDS, CLASS_BYTES = (1, 10239), 2


def _open(path: str):
    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(name)


class Span(InputPartition):
    """Rows of one packet of a file; offset None: samples that no packet has."""

    def __init__(self, path: str, offset: int | None, rows: int, first: int):
        self.path, self.offset, self.rows, self.first = path, offset, rows, first


#: Spans are dealt to tasks until these bytes are reached; opening a file counts as so many.
SHARE, OPENING = 4 << 20, 64 << 10
#: Rows of one batch, about.
BATCH = 1 << 16


class Share(InputPartition):
    """Spans of a task, and paths of files that it looks through itself; rows: those that spans read from files, offset: where the first of these lies, or None."""

    def __init__(self, items: list):
        self.items = items
        read = [x for x in items if isinstance(x, Span) and x.offset is not None]
        self.rows, self.offset = sum(x.rows for x in read), read[0].offset if read else None


def shares(sized: Iterator[tuple]) -> list[Share]:
    """Items (item, bytes) dealt in order to as few tasks as SHARE allows."""
    out, held, size = [], [], 0
    for item, n in sized:
        held.append(item)
        size += n + OPENING
        if size >= SHARE:
            out.append(Share(held))
            held, size = [], 0
    return [*out, Share(held)] if held else out


def bounds(filters: list, column: str) -> tuple[int | None, int | None, list]:
    """(least, past the most, what is left) of the filters on a column of whole numbers."""
    low, high, left = None, None, []
    for f in filters:
        at = getattr(f, "value", None)
        if getattr(f, "attribute", None) != (column,) or not isinstance(at, int):
            left.append(f)
        elif isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)) or isinstance(f, (LessThan, LessThanOrEqual)):
            if isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)):
                low = max(at + isinstance(f, GreaterThan), at if low is None else low)
            if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                high = min(at + (not isinstance(f, LessThan)), high if high is not None else at + 1)
        else:
            left.append(f)
    return low, high, left


def listed(filters: list, column: str) -> tuple[set | None, list]:
    """(values a column may have, what is left) of the filters."""
    found, left = None, []
    for f in filters:
        mine = getattr(f, "attribute", None) == (column,) and isinstance(f, (EqualTo, In))
        if mine:
            these = {f.value} if isinstance(f, EqualTo) else set(f.value)
            found = these if found is None else found & these
        else:
            left.append(f)
    return found, left


class SampleReader(DataSourceReader):
    """Packets are found by hopping over their heads, one small read each; their rows are cut into ranges of split_bytes.

    Files no longer than split_bytes are looked through by the task that reads them. A
    task takes many spans, and many files. Packets shorter than the stride are skipped. One that begins before the end of the
    one before it starts the recording anew: nothing before it counts. Samples between
    packets, and before the first one, are zeros. Ranges and channels that are asked
    for, by options or by filters, decide which bytes are read.
    """

    def __init__(self, options: dict):
        self.paths = options["path"].split("\n")
        self.header, self.channels, self.period = int(options["header_bytes"]), int(options["channels"]), int(options.get("period", 1))
        self.pick = [int(c) for c in options["pick"].split(",")] if options.get("pick") else list(range(self.channels))
        self.every, self.split, self.fill = int(options.get("every", 1)), int(options.get("split_bytes", 16 << 20)), options.get("fill", "true") == "true"
        self.start, self.stop = int(options.get("start") or 0), int(options["stop"]) if options.get("stop") else None

    def packets(self, path: str) -> list[tuple[int, int, int]]:
        """(first sample, samples, byte offset) of the packets that count."""
        found, at, width = [], self.header, 2 * self.channels
        with _open(path) as f:
            size = f.size()
            while at + PACKET_HEAD <= size:
                f.seek(at)
                head = f.read(PACKET_HEAD)
                if head[0] != 1:
                    raise ValueError(f"no packet at byte {at}")
                start, n = (int(x) for x in np.frombuffer(head[1:], "<u4"))
                at += PACKET_HEAD
                if n >= self.every:
                    start = round(start / self.period)
                    if found and start < found[-1][0] + found[-1][1]:
                        found = []
                    found.append((start, n, at))
                at += n * width
        return found

    def spans(self, path: str) -> Iterator[Span]:
        width, end = 2 * self.channels, 0
        step = max(1, self.split // width)

        def cut(offset: int | None, first: int, n: int) -> Iterator[Span]:
            low, high = max(first, self.start), first + n if self.stop is None else min(first + n, self.stop)
            for k in range(low, high, step):
                yield Span(path, None if offset is None else offset + (k - first) * width, min(step, high - k), k)

        for start, n, offset in self.packets(path):
            if self.fill and start > end:
                yield from cut(None, end, start - end)
            yield from cut(offset, start, n)
            end = start + n

    def partitions(self) -> list[Share]:
        def sized() -> Iterator[tuple]:
            for path in self.paths:
                with _open(path) as f:
                    size = f.size()
                if size <= self.split:
                    yield path, size
                else:
                    yield from ((x, 2 * self.channels * x.rows) for x in self.spans(path))

        return shares(sized())

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for item in share.items:
            for span in self.spans(item) if isinstance(item, str) else [item]:
                index = span.first + np.arange(span.rows)
                keep = index % self.every == 0
                if span.offset is None:
                    rows = np.zeros((span.rows, self.channels), "<i2")
                else:
                    with _open(span.path) as f:
                        f.seek(span.offset)
                        rows = np.frombuffer(f.read(span.rows * 2 * self.channels), "<i2").reshape(-1, self.channels)
                held.append((span.path, index[keep], rows[keep]))
                size += int(keep.sum()) * len(self.pick)
                if size >= BATCH:
                    yield self._batch(held)
                    held, size = [], 0
        if held:
            yield self._batch(held)

    def _batch(self, held: list[tuple]) -> pa.RecordBatch:
        n, index, rows = [len(i) for _, i, _ in held], np.concatenate([i for _, i, _ in held]), np.concatenate([r for *_, r in held])
        paths = np.repeat(np.array([p for p, *_ in held], object), n)
        many = len(self.pick)
        return pa.RecordBatch.from_arrays([pa.array(np.tile(paths, many), pa.string()), pa.array(np.repeat(np.array(self.pick, np.int32), len(index))), pa.array(np.tile(index, many)), pa.array(rows[:, self.pick].T.reshape(-1))], ["path", "channel_id", "sample_idx", "v"])


class AskedSampleReader(SampleReader):
    """The same where the session has filter pushdown; Spark takes no reader with it elsewhere."""

    def pushFilters(self, filters: list) -> list:
        low, high, left = bounds(filters, "sample_idx")
        self.start = max(self.start, low or 0)
        if high is not None:
            self.stop = high if self.stop is None else min(self.stop, high)
        wanted, left = listed(left, "channel_id")
        if wanted is not None:
            self.pick = [c for c in self.pick if c in wanted]
        return left


class SampleSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recording_samples"

    def schema(self) -> str:
        return "path string, channel_id int, sample_idx long, v short"

    def reader(self, schema) -> SampleReader:
        return (AskedSampleReader if self.options.get("push") == "true" else SampleReader)(self.options)


class PacketReader(DataSourceReader):
    """Fixed-width packets behind a header, cut into byte ranges; packets that aren't asked for are dropped before they leave the task."""

    def __init__(self, options: dict):
        self.paths, self.header, self.width = options["path"].split("\n"), int(options["header_bytes"]), int(options["packet_bytes"])
        self.split, self.waveforms = int(options.get("split_bytes", 16 << 20)), options.get("waveforms", "true") == "true"
        self.ids = {int(x) for x in options["packet_ids"].split(",")} if options.get("packet_ids") else None

    def partitions(self) -> list[Share]:
        step = max(1, self.split // self.width)

        def sized() -> Iterator[tuple]:
            for path in self.paths:
                with _open(path) as f:
                    n = (f.size() - self.header) // self.width
                for k in range(0, n, step):
                    yield Span(path, self.header + k * self.width, min(step, n - k), k), min(step, n - k) * self.width

        return shares(sized())

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for span in share.items:
            held.append((span.path, self._rows(span)))
            size += len(held[-1][1])
            if size >= BATCH:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    def _rows(self, span: Span) -> np.ndarray:
        with _open(span.path) as f:
            f.seek(span.offset)
            raw = f.read(span.rows * self.width)
        rows = np.frombuffer(raw, np.dtype([("timestamp", "<u4"), ("packet_id", "<u2"), ("payload", f"V{self.width - 6}")]))
        return rows if self.ids is None else rows[np.isin(rows["packet_id"], list(self.ids))]

    def _batch(self, held: list[tuple]) -> pa.RecordBatch:
        rows = np.concatenate([r for _, r in held])
        paths = np.repeat(np.array([p for p, _ in held], object), [len(r) for _, r in held])
        spike = (rows["packet_id"] >= SPIKE_IDS[0]) & (rows["packet_id"] <= SPIKE_IDS[1])
        payload = [bytes(x) if self.waveforms or not s else bytes(x)[:CLASS_BYTES] for x, s in zip(rows["payload"], spike, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(rows["timestamp"].astype(np.int64)), pa.array(rows["packet_id"].astype(np.int32)), pa.array(payload, pa.binary())], ["path", "timestamp", "packet_id", "payload"])


class AskedPacketReader(PacketReader):
    """The same where the session has filter pushdown; Spark takes no reader with it elsewhere."""

    def pushFilters(self, filters: list) -> list:
        wanted, left = listed(filters, "packet_id")
        if wanted is not None:
            self.ids = wanted if self.ids is None else self.ids & wanted
        return left


class PacketSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recording_packets"

    def schema(self) -> str:
        return "path string, timestamp long, packet_id int, payload binary"

    def reader(self, schema) -> PacketReader:
        return (AskedPacketReader if self.options.get("push") == "true" else PacketReader)(self.options)


def _pushes(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")


def _joined(paths: str | list[str]) -> str:
    return paths if isinstance(paths, str) else "\n".join(paths)


def scan_samples(spark: SparkSession, paths: str | list[str], header_bytes: int, channels: int, pick: list[int] | None = None, start: int | None = None, stop: int | None = None, every: int = 1, split_bytes: int = 16 << 20, period: int = 1, fill: bool = True) -> DataFrame:
    """(path, channel_id, sample_idx, v) of some or all channels of recordings, a stride and a sample range; pauses are zeros unless fill is off.

    Only the bytes of [start, stop) are read. Filters on sample_idx and channel_id do
    the same where the session has spark.sql.python.filterPushdown.enabled.
    """
    spark.dataSource.register(SampleSource)
    options = {"path": _joined(paths), "header_bytes": str(header_bytes), "channels": str(channels), "every": str(every), "split_bytes": str(split_bytes), "pick": ",".join(map(str, pick or [])), "period": str(period), "fill": str(fill).lower(), "start": str(start or 0), "stop": "" if stop is None else str(stop), "push": _pushes(spark)}
    return spark.read.format("recording_samples").options(**options).load()


def scan_packets(spark: SparkSession, paths: str | list[str], header_bytes: int, packet_bytes: int, split_bytes: int = 16 << 20, electrodes: list[int] | None = None, digital_id: int = 0, waveforms: bool = True) -> DataFrame:
    """(path, timestamp, packet_id, payload) of event files; electrodes: only their spikes and the digital events; waveforms off: spikes keep their class alone."""
    spark.dataSource.register(PacketSource)
    ids = "" if electrodes is None else ",".join(map(str, [digital_id, *electrodes]))
    return spark.read.format("recording_packets").options(path=_joined(paths), header_bytes=str(header_bytes), packet_bytes=str(packet_bytes), split_bytes=str(split_bytes), packet_ids=ids, waveforms=str(waveforms).lower(), push=_pushes(spark)).load()


def _create(path: str):
    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(name)


def write_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For mapInPandas over (path, size): a file of that many zero bytes each."""
    for pdf in batches:
        for path, size in zip(pdf["path"], pdf["size"], strict=True):
            with _create(path) as f:
                f.write(b"\0" * int(size))
        yield pdf[["path"]]


def write_recordings(df: DataFrame, folder: str, recording: str, channel: str, index: str, value: str, channels: int, header_bytes: int = 32) -> DataFrame:
    """(recording, path, samples) of one file for each recording: a packet for each run of samples that all channels have in turn; a recording is written by one task, in sample order."""
    kind = df.schema[recording].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name, path = pdf["r"].iloc[0], f"{folder}/{pdf['r'].iloc[0]}.rec"
        wide = pdf.pivot(index="i", columns="c", values="v").reindex(columns=range(channels)).fillna(0).astype("<i2").sort_index()
        at, rows = wide.index.to_numpy(), wide.to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(at) != 1) + 1).tolist(), len(at)]
        with _create(path) as f:
            f.write(b"\0" * header_bytes)
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                f.write(b"\1" + np.array([at[a], b - a], "<u4").tobytes() + rows[a:b].tobytes())
        return pd.DataFrame({"recording": [name], "path": [path], "samples": [len(at)]})

    rows = df.select(F.col(recording).alias("r"), F.col(channel).cast("int").alias("c"), F.col(index).cast("long").alias("i"), F.col(value).cast("short").alias("v"))
    return rows.groupBy("r").applyInPandas(run, f"recording {kind}, path string, samples long")


def write_packets(df: DataFrame, folder: str, recording: str, timestamp: str, packet_id: str, payload: str, packet_bytes: int, header_bytes: int = 8) -> DataFrame:
    """(recording, path, packets) of one event file for each recording, in order of time; payloads are filled up with zeros."""
    kind = df.schema[recording].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name, path = pdf["r"].iloc[0], f"{folder}/{pdf['r'].iloc[0]}.ev"
        with _create(path) as f:
            f.write(b"\0" * header_bytes)
            pdf = pdf.sort_values(["t", "k"])
            rows = np.empty(len(pdf), [("t", "<u4"), ("k", "<u2"), ("p", f"V{packet_bytes - 6}")])
            rows["t"], rows["k"] = pdf["t"], pdf["k"]
            rows["p"] = np.frombuffer(b"".join(bytes(body).ljust(packet_bytes - 6, b"\0") for body in pdf["p"]), f"V{packet_bytes - 6}")
            f.write(rows.tobytes())
        return pd.DataFrame({"recording": [name], "path": [path], "packets": [len(pdf)]})

    rows = df.select(F.col(recording).alias("r"), F.col(timestamp).cast("long").alias("t"), F.col(packet_id).cast("int").alias("k"), F.col(payload).alias("p"))
    return rows.groupBy("r").applyInPandas(run, f"recording {kind}, path string, packets long")


def little_endian(payload, start: int, size: int):
    """An unsigned number of size bytes at start (from 0) of a binary column."""
    return F.conv(F.concat(*(F.hex(F.substring(payload, start + k + 1, 1)) for k in reversed(range(size)))), 16, 10).cast("long")


def packet_tables(packets: DataFrame, digital_id: int = 0) -> dict[str, DataFrame]:
    """One table per kind: spikes (electrode and unit class) for ids 1..10239, digital events (reason and value) for digital_id."""
    spikes = packets.where(F.col("packet_id").between(*SPIKE_IDS)).select("path", "timestamp", F.col("packet_id").alias("electrode"), little_endian(F.col("payload"), 0, 1).alias("unit_class"))
    digital = packets.where(F.col("packet_id") == digital_id).select("path", "timestamp", little_endian(F.col("payload"), 0, 1).alias("reason"), little_endian(F.col("payload"), 2, 2).alias("value"))
    return {"spikes": spikes, "digital": digital}
