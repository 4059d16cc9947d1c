"""Suffix-array dedup: remove every byte covered by a long string that occurs elsewhere.

Which texts share long strings is found by anchors: of the ``ANCHOR``-byte strings
inside any ``length``-byte window, the leftmost one of least hash. Equal windows
have the same anchor at the same offset, so every repeat shows as an anchor that
occurs twice, and the windows of one anchor in one text are one region of a few
hundred bytes. Equal texts, and equal regions of one anchor, repeat as a whole and
are collapsed to one. A region that equals no other can hold a repeat only if
another region of its anchor has the same bytes for half of what is left of a
window on the anchor's one side or the other. Those regions, with one of each kind
they may share strings with, are gathered by anchor into shards of about
``shard_bytes``. Each shard is one suffix array, built by induced sorting, and a
string repeats where the permuted common prefix with a neighbour in the array
reaches ``length``.

Equal windows always meet in one shard and regions never reach over a document's
end, so the result is exact. Tasks settle equal regions of a batch before anything
is shuffled, so a hot passage posts a row per batch. The places of an anchor meet in
one task only up to ``crowd`` of them, by a count taken first; where there are more,
regions and what they share are told by grouped counts on the anchor with the region,
its left and its right, joined back by those keys. An anchor with more than
``hot_regions`` different regions is dealt out window by window instead of sorted,
grouped by the windows' own content.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import key_runs, run_starts, staged, table
from sluice.llm.shingles import _POWERS, mix
from sluice.llm.suffix_arrays import repeated_starts

LENGTH = 200
ANCHOR = 32
SLAB = 1 << 19
SHARD_BYTES = 2 << 20
HOT_REGIONS = 20_000
CROWD = 2_000
#: What a region turns out to be: repeated as a whole, to be sorted, beside such a
#: one in its shard, or of a hot anchor.
SETTLED, OPEN, BESIDE, HOT = range(4)
#: How a task posts a place: alone in its batch, standing for equal ones, or one of those.
SINGLE, COPIED, ALONG = range(3)


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int) -> list[np.ndarray]:
    """Anchors of every window of the texts between ``bounds``.

    Parallel arrays: text, anchor hash, first and last window start, hash of the
    region, and hashes of the anchor with half a window's rest to its left and to
    its right (0 where no window of the region has that much there).
    """
    k = min(ANCHOR, length)
    wide, half = length - k + 1, (length - k) // 2
    n = len(raw)
    if n < length:
        return [np.zeros(0, np.int64) for _ in range(7)]
    with np.errstate(over="ignore"):
        up, down = _POWERS.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        hashes = mix((sums[k:] - sums[: n - k + 1]) * down[: n - k + 1])
        bits = np.uint64(max(1, int(n).bit_length()))
        low = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while span * 2 <= wide:
            low = np.minimum(low[: len(low) - span], low[span:])
            span *= 2
        low = np.minimum(low[: n - length + 1], low[wide - span : wide - span + n - length + 1])
        place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        count = np.maximum(0, np.diff(bounds) - length + 1)
        texts = np.repeat(np.arange(len(count)), count)
        starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + bounds[texts]
        place = place[starts]
        new = np.append(True, (place[1:] != place[:-1]) | (texts[1:] != texts[:-1])) if len(place) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place))[: len(first)] - 1
        text, place, first, last = texts[first], place[first], starts[first], starts[last]

        def between(a, b):
            return mix((sums[b] - sums[a]) * down[a])

        region = between(first, last + length)
        left = np.where(place - first >= half, between(np.maximum(place - half, 0), place + k), np.uint64(0))
        right = np.where(place - last <= length - k - half, between(place, np.minimum(place + k + length - k - half, n)), np.uint64(0))
    return [
        text, hashes[place].view(np.int64), first - bounds[text], last - bounds[text],
        *(x.view(np.int64) for x in (region, left, right)),
    ]


def text_anchors(texts: pa.Array, length: int):
    """The arrays of ``anchors`` but the first, for every text in order."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + SLAB, side="right")) - 1
        if to <= at:  # longer than a slab: overlapping parts
            whole = data[offsets[at] : offsets[at + 1]]
            parts = []
            for s in range(0, max(1, len(whole) - length + 1), SLAB):
                piece = whole[s : s + SLAB + length - 1]
                _, h, lo, hi, *rest = anchors(piece, np.array([0, len(piece)]), length)
                parts.append((h, lo + s, hi + s, *rest))
            yield [np.concatenate(x) for x in zip(*parts, strict=True)]
            at += 1
            continue
        text, *rest = anchors(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], length)
        cuts = np.searchsorted(text, np.arange(to - at + 1))
        for s, e in itertools.pairwise(cuts):
            yield [x[s:e] for x in rest]
        at = to


def equal_rows(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of parallel columns: how many rows equal it, and whether it is the first of them."""
    n = len(columns[0])
    order = np.lexsort(columns[::-1])
    starts = run_starts([c[order] for c in columns])
    counts, first = np.empty(n, np.int64), np.zeros(n, bool)
    counts[order] = np.repeat(np.diff(starts), np.diff(starts))
    first[order[starts[:-1]]] = True
    return counts, first


def region_roles(h, region, left, right, copied, hot_regions: int) -> tuple[np.ndarray, np.ndarray]:
    """(settled, other role or -1) for each place of some anchors, all places of each given;
    ``copied`` places are known to have an equal one."""
    copies, first = equal_rows(h, region)
    settled = (copies > 1) | copied
    role = np.full(len(h), -1, np.int8)
    at = np.flatnonzero(first)
    shares = np.zeros(len(at), bool)
    for side in (left[at], right[at]):
        alike, _ = equal_rows(h[at], side)
        shares |= (side != 0) & (alike > 1)
    at = at[shares]
    if len(at):
        _, anchor = np.unique(h[at], return_inverse=True)
        alone = ~settled[at]
        any_alone = np.bincount(anchor, weights=alone) > 0
        crowded = np.bincount(anchor) > hot_regions
        role[at] = np.where(alone, OPEN, BESIDE)
        role[at[crowded[anchor]]] = HOT
        role[at[~any_alone[anchor]]] = -1
    return settled, role


def crowd_roles(places: DataFrame, hot_regions: int) -> DataFrame:
    """(h, tid, lo, hi, role) as by ``region_roles``, without gathering the places of an anchor."""
    places = places.dropDuplicates(["h", "tid", "lo", "state"])
    regions = staged(
        places.groupBy("h", "region")
        .agg(
            ((F.count(F.lit(1)) > 1) | (F.max("state") == COPIED)).alias("settled"), F.max("left").alias("left"),
            F.max("right").alias("right"), F.min(F.struct("tid", "lo", "hi")).alias("place"),
        ),
        "crowd-regions",
    )
    sharing = regions
    for side in ("left", "right"):  # written, so that a crowded key is split in the join
        alike = regions.where(F.col(side) != 0).groupBy("h", side).count().where("count > 1")
        alike = staged(alike.select("h", side, F.lit(True).alias(f"same_{side}")), f"crowd-{side}")
        sharing = sharing.join(alike, ["h", side], "left")
    sharing = staged(
        sharing.where(F.col("same_left").isNotNull() | F.col("same_right").isNotNull()).select("h", "place.*", "settled"),
        "crowd-sharing",
    )
    anchor = staged(
        sharing.groupBy("h").agg((F.count(F.lit(1)) > hot_regions).alias("hot"), F.max(~F.col("settled")).alias("alone")),
        "crowd-anchors",
    )
    role = F.when(F.col("hot"), HOT).when(F.col("settled"), BESIDE).otherwise(OPEN)
    return (
        places.join(regions.where("settled").select("h", "region"), ["h", "region"])
        .select("h", "tid", "lo", "hi", F.lit(SETTLED).cast("byte").alias("role"))
        .unionByName(sharing.join(anchor.where("alone"), "h").select("h", "tid", "lo", "hi", role.cast("byte").alias("role")))
    )


def cut_spans(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """``text`` without the union of half-open byte spans: (left, bytes removed, maximal runs)."""
    if not len(starts):
        return text, 0, 0
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    new = np.append(True, starts[1:] > ends[:-1])
    first = starts[new]
    last = ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]
    kept, at = [], 0
    for s, e in zip(first.tolist(), last.tolist(), strict=True):
        kept.append(text[at:s])
        at = e
    kept.append(text[at:])
    return b"".join(kept), int((last - first).sum()), len(first)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    hot_regions: int = HOT_REGIONS,
    crowd: int = CROWD,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept (the bytes left).

    Each byte covered by a ``length``-byte string that also starts at another place
    of any text, the same included, is removed; matches lie within one document.
    Null is the empty text; texts shorter than ``length`` lose nothing. Repeated
    rows are documents of their own, so both lose what they share. Null ids give a
    row each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    seed = 0
    while True:  # a number for every different text, by the first seed that tells all apart
        numbered = rows.select("id", "t", F.xxhash64("t", F.lit(seed)).alias("tid"))
        long = numbered.where(F.octet_length("t") >= length)
        texts = staged(
            long.groupBy("tid").agg(
                F.count(F.lit(1)).alias("copies"), F.min(F.sha2("t", 256)).alias("a"), F.max(F.sha2("t", 256)).alias("b")
            ),
            "text-numbers",
        )
        if not texts.where("a <> b").head(1):
            break
        seed += 1
    columns = "h long, tid long, lo int, hi int, region long, left long, right long, state byte"

    def find_anchors(batches):
        seen: set[int] = set()  # texts this task has anchored
        for batch in batches:
            tids = batch.column("tid").to_numpy()
            fresh = []
            for i, tid in enumerate(tids.tolist()):
                if tid not in seen:
                    seen.add(tid)
                    fresh.append(i)
            if not fresh:
                continue
            found = list(text_anchors(batch.column("t").take(pa.array(fresh, pa.int64())), length))
            h, lo, hi, region, left, right = (np.concatenate(x) for x in zip(*found, strict=True))
            tid = np.repeat(tids[fresh], [len(f[0]) for f in found])
            copies, first = equal_rows(h, region)
            # One of equal regions stands for all; the others go along.
            state = np.where(first, np.where(copies > 1, COPIED, SINGLE), ALONG).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(x) for x in (np.where(first, h, 0), tid, lo.astype(np.int32), hi.astype(np.int32))),
                    *(pa.array(np.where(first, x, 0)) for x in (region, left, right)),
                    pa.array(state),
                ],
                names=["h", "tid", "lo", "hi", "region", "left", "right", "state"],
            )

    def judge_regions(batches):
        for part in key_runs(batches, ["h"]):
            cols = {c: part.column(c).to_numpy() for c in ("h", "tid", "lo", "hi", "region", "left", "right", "state")}
            same = np.zeros(len(cols["h"]), bool)  # a copied text may be posted by several tasks
            same[1:] = (cols["h"][1:] == cols["h"][:-1]) & (cols["tid"][1:] == cols["tid"][:-1]) & (cols["lo"][1:] == cols["lo"][:-1])
            at = np.flatnonzero(~same)
            beside, _ = equal_rows(cols["h"][at])
            at = at[(beside > 1) | (cols["state"][at] == COPIED)]
            settled, role = region_roles(
                *(cols[c][at] for c in ("h", "region", "left", "right")), cols["state"][at] == COPIED, hot_regions
            )
            out = [(at[settled], np.full(settled.sum(), SETTLED, np.int8)), (at[role >= 0], role[role >= 0])]
            out = [(*(cols[c][rows_] for c in ("h", "tid", "lo", "hi")), kinds) for rows_, kinds in out]
            merged = [np.concatenate(x) for x in zip(*out, strict=True)]
            if len(merged[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged], names=["h", "tid", "lo", "hi", "role"])

    posted = staged(long.select("tid", "t").mapInArrow(find_anchors, columns), "places")
    places = few = posted.where(F.col("state") != ALONG)
    crowds = staged(places.groupBy("h").count().where(F.col("count") > crowd).select("h"), "crowds")
    crowded = bool(crowds.head(1))
    if crowded:
        few = places.join(crowds, "h", "left_anti")
    judged = (
        few.repartition("h").sortWithinPartitions("h", "state", "tid", "lo")
        .mapInArrow(judge_regions, "h long, tid long, lo int, hi int, role byte")
    )
    if crowded:
        judged = judged.unionByName(crowd_roles(places.join(crowds, "h", "left_semi"), hot_regions))
    judged = staged(judged, "regions")
    wanted = judged.where(F.col("role") != SETTLED).groupBy("tid").agg(
        F.collect_list(F.struct("h", "lo", "hi", "role")).alias("w")
    )

    def cut_regions(batches):
        seen: set[int] = set()  # copies of a text have the same regions
        for batch in batches:
            for tid, w, text in zip(*(batch.column(c) for c in ("tid", "w", "t")), strict=True):
                tid = tid.as_py()
                if tid in seen:
                    continue
                seen.add(tid)
                raw = text.as_py().encode()
                fields = w.values
                lo, hi = (fields.field(c).to_pylist() for c in ("lo", "hi"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tid] * len(lo), pa.int64()), fields.field("h"), fields.field("lo"), fields.field("role"),
                        pa.array([raw[a : b + length] for a, b in zip(lo, hi, strict=True)], pa.binary()),
                    ],
                    names=["tid", "h", "lo", "role", "bytes"],
                )

    cut = staged(
        long.select("tid", "t").join(wanted, "tid").select("tid", "w", "t")
        .mapInArrow(cut_regions, "tid long, h long, lo int, role byte, bytes binary"),
        "region-bytes",
    )
    total = cut.where(F.col("role") != HOT).agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def sort_shards(batches):
        for part in key_runs(batches, ["shard"]):
            shard, tid, lo, role = (part.column(c).to_numpy() for c in ("shard", "tid", "lo", "role"))
            pieces = part.column("bytes").to_pylist()
            starts = run_starts([shard])
            for s, e in itertools.pairwise(starts):
                out = []
                for i, found in zip(range(s, e), repeated_starts(pieces[s:e], length), strict=True):
                    if role[i] == OPEN and len(found):
                        gap = np.flatnonzero(np.diff(found) > 1)
                        first = found[np.append(0, gap + 1)] + lo[i]
                        last = found[np.append(gap, len(found) - 1)] + lo[i] + length
                        out.append((np.full(len(first), tid[i]), first, last))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)], names=["tid", "s", "e"]
                    )

    # A copied text may be cut by several tasks: once is enough, for it is removed as a whole.
    sorted_spans = (
        cut.where(F.col("role") != HOT).dropDuplicates(["tid", "lo"])
        .withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
        .select("shard", "tid", "lo", "role", "bytes").repartition("shard").sortWithinPartitions("shard", "tid", "lo")
        .mapInArrow(sort_shards, "tid long, s long, e long")
    )
    windows = (
        cut.where(F.col("role") == HOT).dropDuplicates(["tid", "lo"])
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)))
        .select(
            "tid", (F.col("lo") + F.col("o")).cast("long").alias("s"),
            F.unhex(F.substring(F.sha2(F.substring("bytes", F.col("o") + 1, F.lit(length)), 256), 1, 32)).alias("w"),
        )
    )
    repeated = staged(windows.groupBy("w").count().where("count > 1").select("w"), "windows")
    spans = (
        judged.where(F.col("role") == SETTLED).select("tid", "lo", "hi")
        .unionByName(posted.where(F.col("state") == ALONG).select("tid", "lo", "hi"))
        .select("tid", F.col("lo").cast("long").alias("s"), (F.col("hi") + length).cast("long").alias("e"))
        .unionByName(sorted_spans)
        .unionByName(windows.join(repeated, "w").select("tid", "s", (F.col("s") + length).alias("e")))
        .groupBy("tid").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
        .select("tid", F.col("spans.s").alias("s"), F.col("spans.e").alias("e"))
        .join(texts.where("copies > 1").select("tid"), "tid", "left_anti")
        .unionByName(
            texts.where("copies > 1").select(
                "tid", F.array(F.lit(0).cast("long")).alias("s"), F.array(F.lit(2**62).cast("long")).alias("e")
            )
        )
    )
    spans = staged(spans, "spans")
    id_type = rows.schema["id"].dataType.simpleString()
    columns = f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary"

    def apply(batches):
        for batch in batches:
            ids = batch.column("id")
            texts, s, e = (batch.column(c) for c in ("t", "s", "e"))
            at = 0
            while at < batch.num_rows:
                first, out, held = at, [], 0
                while at < batch.num_rows and held < 8 << 20:
                    raw = texts[at].as_py().encode()
                    a = np.array(s[at].as_py() or [], np.int64)
                    b = np.minimum(np.array(e[at].as_py() or [], np.int64), len(raw))
                    kept, removed, runs = cut_spans(raw, a, b)
                    out.append((len(raw), removed, runs, kept))
                    held += len(raw)
                    at += 1
                n, removed, runs, kept = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, at - first), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                        pa.array(runs, pa.int64()), pa.array(kept, pa.binary()),
                    ],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return (
        numbered.join(spans, "tid", "left").select("id", "t", "s", "e")
        .mapInArrow(apply, columns).withColumnRenamed("id", id_col)
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
