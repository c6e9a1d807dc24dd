"""Copies of images by local descriptors.

Corners are found on five scales (Harris measure, local maxima refined below a pixel, the strongest KEYPOINTS of each scale).
Each gets an orientation from its patch's intensity centroid and 256 binary tests of pixel pairs, sampled between pixels and
turned by that orientation; the pairs of a test lie across the orientation, since along it the centroid foretells the order.
Descriptors that agree on one of their eight 32-bit words meet; those that agree in all but SPARE of the next 64 bits are
matches. Matches of two images vote for a rotation, scale and shift; INLIERS distinct matches of one vote make a link, so crops,
turns, resized ones and edits of brightness or noise link, and chance matches don't. Equal images are one node. Images are dealt
into blocks, and each two blocks meet in a cell of their own, in which all descriptors that share a word are compared and all
matches of a pair of images are counted: matches, most of them by chance, are never shuffled. An image goes to as many cells as
there are blocks, so both the shuffle and the comparisons grow with the square of the images; groups are the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.components import components
from postmill.llm.shared import materialize

SIDE = 96
SCALES, KEYPOINTS, RADIUS, MARGIN = (1.0, 1.15, 1.32, 1.52, 1.75), (11, 9, 8, 7, 6), 9, 14
SPARE, INLIERS = 16, 4
#: two blocks of CELL_ROWS images at most on average meet in a cell; there are BLOCKS blocks at least; comparisons that are made at once
WORDS, CELL_ROWS, BLOCKS, COMPARISONS = 8, 16384, 4, 1 << 19
TURN, ZOOM, SHIFT = np.pi / 4, 0.5, 16.0
OFFSETS = np.stack(np.meshgrid(np.arange(-RADIUS, RADIUS + 1), np.arange(-RADIUS, RADIUS + 1), indexing="ij"), -1).reshape(-1, 2)
OFFSETS = OFFSETS[(OFFSETS**2).sum(1) <= RADIUS**2]
#: place packs x, y (16 bits each, in 1/64 pixels), angle (16 bits of a turn) and number of the scale (8 bits)
DESCRIBED = "image_id long, h1 long, h2 long, place array<long>, d0 array<long>, d1 array<long>, d2 array<long>, d3 array<long>"


def _tests() -> np.ndarray:
    """256 pairs of points in the patch: nearly level along the orientation, apart across it."""
    random, found = np.random.default_rng(5), []
    while len(found) < 256:
        a, b = random.uniform(-RADIUS, RADIUS, (2, 2))
        if max((a**2).sum(), (b**2).sum()) <= RADIUS**2 and abs(a[0] - b[0]) <= 1.5 and abs(a[1] - b[1]) >= 2:
            found.append((a, b))
    return np.array(found)


TESTS = _tests()


def _packed(shape: np.ndarray) -> np.ndarray:
    x, y = (np.rint(shape[:, i] * 64).astype(np.int64) for i in range(2))
    angle = np.rint(np.mod(shape[:, 2], 2 * np.pi) / (2 * np.pi) * 65535).astype(np.int64)
    return x << 40 | y << 24 | angle << 8 | np.searchsorted(SCALES, shape[:, 3] - 1e-6)


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return (place >> 40) / 64, (place >> 24 & 0xFFFF) / 64, (place >> 8 & 0xFFFF) / 65535 * 2 * np.pi, np.array(SCALES)[place & 0xFF]


def _blur(images: np.ndarray, times: int = 1) -> np.ndarray:
    for axis in (1, 2) * times:
        padded = np.pad(images, [(2, 2) if a == axis else (0, 0) for a in range(3)], mode="edge")
        cut = [padded[:, i : i + images.shape[1]] if axis == 1 else padded[:, :, i : i + images.shape[2]] for i in range(5)]
        images = (cut[0] + 4 * cut[1] + 6 * cut[2] + 4 * cut[3] + cut[4]) / 16
    return images


def _shrunk(images: np.ndarray, by: float) -> np.ndarray:
    for axis in (1, 2) if by > 1 else ():
        at = np.arange(int((images.shape[axis] - 1) / by) + 1) * by
        low = np.minimum(at.astype(int), images.shape[axis] - 2)
        part = (at - low).astype(np.float32).reshape([-1 if a == axis else 1 for a in range(3)])
        images = np.take(images, low, axis) * (1 - part) + np.take(images, low + 1, axis) * part
    return images


def _between(images: np.ndarray, n: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values between pixels."""
    top, left = np.clip(y.astype(int), 0, images.shape[1] - 2), np.clip(x.astype(int), 0, images.shape[2] - 2)
    v, u = (y - top).astype(np.float32), (x - left).astype(np.float32)
    return (images[n, top, left] * (1 - u) + images[n, top, left + 1] * u) * (1 - v) + (images[n, top + 1, left] * (1 - u) + images[n, top + 1, left + 1] * u) * v


def describe(images: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image number, [x, y, angle, scale], descriptors as 4 uint64) of images (n, height, width) of one shape, by number."""
    number, shapes, out = [np.zeros(0, int)], [np.zeros((0, 4))], [np.zeros((0, 4), np.uint64)]
    for by, most in zip(SCALES, KEYPOINTS, strict=True):
        level = _shrunk(_blur(images.astype(np.float32), round((by**2 - 1) / 2)), by)
        high, wide = level.shape[1:]
        if min(high, wide) < 2 * MARGIN + 3:
            break
        fine, smooth = _blur(level, 2), _blur(level, 3)
        gy, gx = np.gradient(fine, axis=(1, 2))
        xx, yy, xy = _blur(gx * gx), _blur(gy * gy), _blur(gx * gy)
        measure = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        inner = measure[:, MARGIN:-MARGIN, MARGIN:-MARGIN]
        top = np.ones(inner.shape, bool)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if dx or dy:
                    top &= inner > measure[:, MARGIN + dy : high - MARGIN + dy, MARGIN + dx : wide - MARGIN + dx]
        n, y, x = np.nonzero(top & (inner > 1e-6))
        y, x = y + MARGIN, x + MARGIN
        order = np.lexsort((-measure[n, y, x], n))
        order = order[np.arange(len(n)) - np.searchsorted(n[order], n[order]) < most]
        n, y, x = n[order], y[order], x[order]

        def peak(before: np.ndarray, at: np.ndarray, after: np.ndarray) -> np.ndarray:
            return np.clip((before - after) / (2 * (before + after - 2 * at) - 1e-20), -0.5, 0.5)

        at = measure[n, y, x]
        px, py = x + peak(measure[n, y, x - 1], at, measure[n, y, x + 1]), y + peak(measure[n, y - 1, x], at, measure[n, y + 1, x])
        patch = _between(smooth, n[:, None], py[:, None] + OFFSETS[:, 0], px[:, None] + OFFSETS[:, 1])
        patch = patch - patch.mean(1, keepdims=True)
        angle = np.arctan2(patch @ OFFSETS[:, 0].astype(np.float32), patch @ OFFSETS[:, 1].astype(np.float32))
        c, s = np.cos(angle)[:, None, None], np.sin(angle)[:, None, None]
        tx, ty = TESTS[None, :, :, 0], TESTS[None, :, :, 1]
        values = _between(smooth, n[:, None, None], py[:, None, None] + s * tx + c * ty, px[:, None, None] + c * tx - s * ty)
        number.append(n)
        shapes.append(np.stack([px * by, py * by, angle, np.full(len(n), by)], 1))
        out.append(np.packbits(values[:, :, 0] < values[:, :, 1], axis=1).view(">u8").astype(np.uint64))
    number = np.concatenate(number)
    order = np.argsort(number, kind="stable")
    return number[order], np.concatenate(shapes)[order], np.concatenate(out)[order]


def described(images: DataFrame) -> DataFrame:
    """A row per row of images (image_id, pixels: binary of an 8-bit image; width and height, if it is not square): its hashes and keypoints.

    Pixels that don't fill the shape have no keypoints.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, 64) for b in batches for a in range(0, b.num_rows, 64)):
            raw = [np.frombuffer(p or b"", np.uint8) for p in batch.column(3).to_pylist()]
            wide, high = (np.array([int(np.sqrt(len(r))) if v is None else v for v, r in zip(batch.column(i).to_pylist(), raw, strict=True)]) for i in (4, 5))
            places, bits = [np.zeros(0, np.int64)] * len(raw), [np.zeros((0, 4), np.uint64)] * len(raw)
            for w, h in sorted(set(zip(wide.tolist(), high.tolist(), strict=True))):
                chosen = [i for i in np.flatnonzero((wide == w) & (high == h)) if len(raw[i]) == w * h]
                if chosen and min(w, h) >= 2 * MARGIN + 3:
                    n, shape, found = describe(np.stack([raw[i].reshape(h, w) for i in chosen]))
                    cuts = np.searchsorted(n, np.arange(len(chosen) + 1))
                    for k, i in enumerate(chosen):
                        places[i], bits[i] = _packed(shape[cuts[k] : cuts[k + 1]]), found[cuts[k] : cuts[k + 1]]
            cuts = pa.array(np.r_[0, np.cumsum([len(p) for p in places])].astype(np.int32))
            flat = np.concatenate(bits).view(np.int64)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (np.concatenate(places), *(flat[:, i] for i in range(4)))]
            yield pa.record_batch([*batch.columns[:3], *lists], names=["image_id", "h1", "h2", "place", "d0", "d1", "d2", "d3"])

    w, h = (F.col(c).cast("int") if {"width", "height"} <= set(images.columns) else F.lit(None).cast("int") for c in ("width", "height"))
    rows = images.select(F.col("image_id").cast("long"), F.xxhash64("pixels", w, h).alias("h1"), F.xxhash64(F.lit("second"), "pixels", w, h).alias("h2"), "pixels", w.alias("width"), h.alias("height"))
    return rows.mapInArrow(run, DESCRIBED)


def keypoints(rows: DataFrame) -> DataFrame:
    """image_id and the lists place, d0, d1, d2, d3: the rows of described() that have keypoints."""
    return rows.where(F.size("place") > 0).select("image_id", "place", "d0", "d1", "d2", "d3")


LINK = "a long, b long, inliers long"


def _agreed(i: np.ndarray, j: np.ndarray, image: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, image, inliers) of the links that matches of keypoints i and j make; image[i] < image[j], and a match may stand there twice."""
    images = int(image.max()) + 1
    _, back, count = np.unique(image[i] * images + image[j], return_inverse=True, return_counts=True)
    # pairs of fewer than INLIERS matches have no vote of so many
    enough = count[back] >= INLIERS
    i, j = i[enough], j[enough]
    pair = image[i] * images + image[j]
    (x, y, angle_i, scale_i), (x_j, y_j, angle_j, scale_j) = _unpacked(place[i]), _unpacked(place[j])
    turn = np.mod(angle_j - angle_i + np.pi, 2 * np.pi) - np.pi
    zoom = scale_j / scale_i
    c, s = zoom * np.cos(turn), zoom * np.sin(turn)
    dx, dy = x_j - (c * x - s * y), y_j - (s * x + c * y)
    turns, zooms = np.floor(turn / TURN + 0.5), np.floor(np.log2(zoom) / ZOOM + 0.5)
    pairs, inliers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # each match votes on two offset grids per axis, so that no placement lies on a border of both
    for gx, gy in ((gx, gy) for gx in (0.0, 0.5) for gy in (0.0, 0.5)):
        votes = [pair, turns, zooms, np.floor(dx / SHIFT + gx), np.floor(dy / SHIFT + gy), place[i] >> 24]
        order = np.lexsort(votes[::-1])
        votes = [v[order] for v in votes]
        changed = [np.r_[True, v[1:] != v[:-1]][: len(order)] for v in votes]
        new, ballot = np.any(changed, axis=0), np.flatnonzero(np.any(changed[:-1], axis=0))
        if len(ballot):
            pairs.append(votes[0][ballot])
            inliers.append(np.add.reduceat(new, ballot, dtype=np.int64))
    pairs, inliers = np.concatenate(pairs), np.concatenate(inliers)
    order = np.lexsort((-inliers, pairs))
    order = order[(inliers[order] >= INLIERS) & np.r_[True, pairs[order][1:] != pairs[order][:-1]][: len(order)]]
    return pairs[order] // images, pairs[order] % images, inliers[order]


def _meet(a: np.ndarray, b: np.ndarray, image: np.ndarray, place: np.ndarray, bits: np.ndarray, one: bool, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(image, image, inliers) of the links between keypoints a and keypoints b, both sorted by image; one: they are of one block.

    A piece of some images of a, and of b if need be, makes about `most` comparisons, so that memory is bounded whatever words are common.
    """
    if not len(a) or not len(b):
        return
    word, orders, low, count = bits.view("<u4"), [], [], []
    for w in range(WORDS):
        orders.append(np.argsort(word[b, w], kind="stable").astype(np.int32))
        key = word[b, w][orders[w]]
        low.append(np.searchsorted(key, word[a, w]).astype(np.int32))
        count.append(np.searchsorted(key, word[a, w], "right").astype(np.int32) - low[w])
    first = np.flatnonzero(np.r_[True, image[a][1:] != image[a][:-1]])
    cost = np.add.reduceat(np.sum(count, axis=0, dtype=np.int64), first)
    piece = (np.cumsum(cost) - cost) // most
    start = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    ends = np.r_[first[start[1:]], len(a)]
    for at, end, steps in zip(first[start], ends, np.add.reduceat(cost, start), strict=True):
        if steps > 2 * most and image[b[0]] != image[b[-1]]:
            half = int(np.searchsorted(image[b], (image[b[0]] + image[b[-1]]) // 2, "right"))
            for part in (b[:half], b[half:]):
                yield from _meet(a[at:end], part, image, place, bits, one, most)
            continue
        found = []
        for w in range(WORDS):
            n = count[w][at:end]
            i = np.repeat(a[at:end], n)
            j = b[orders[w][np.arange(len(i)) + np.repeat(low[w][at:end] - (np.cumsum(n) - n), n)]]
            more = (w // 2 + 1) % 4
            near = (image[i] < image[j] if one else image[i] != image[j]) & (np.bitwise_count(bits[i, more] ^ bits[j, more]) <= SPARE)
            found.append((i[near], j[near]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(i):
            yield _agreed(np.where(image[i] < image[j], i, j), np.where(image[i] < image[j], j, i), image, place)


def _links_of_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a cell: of rows (side, image_id, place, d0, d1, d2, d3), those of side 0 meet each other, sides 1 and 2 one another."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    length = np.diff(rows["place"].chunk(0).offsets.to_numpy())
    side = np.repeat(rows["side"].to_numpy(), length)
    ids, image = np.unique(rows["image_id"].to_numpy(), return_inverse=True)
    image = np.repeat(image, length)
    order = np.argsort(image, kind="stable").astype(np.int32)
    a, b, one = order[side[order] <= 1], order[side[order] != 1], bool((side == 0).any())
    place, bits = rows["place"].chunk(0).flatten().to_numpy(), np.stack([rows[c].chunk(0).flatten().to_numpy() for c in ("d0", "d1", "d2", "d3")], 1).view(np.uint64)
    del rows, side, order
    for i, j, inliers in _meet(a, b, image, place, bits, one, COMPARISONS):
        yield pa.record_batch([pa.array(v) for v in (ids[i], ids[j], inliers)], names=["a", "b", "inliers"])


def links(points: DataFrame) -> DataFrame:
    """a, b, inliers: images of which at least INLIERS distinct keypoints agree on one placement. points are rows of keypoints() of a table.

    All matches of two images are found in one cell, so only links leave it.
    """
    blocks = max(BLOCKS, -(-points.count() // CELL_ROWS))
    dealt = points.withColumn("block", F.pmod(F.xxhash64("image_id"), F.lit(blocks))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    cell = F.least("block", "other") * blocks + F.greatest("block", "other")
    cells = dealt.select(cell.alias("cell"), side.alias("side"), "image_id", "place", "d0", "d1", "d2", "d3")
    return cells.groupBy("cell").applyInArrow(_links_of_cell, LINK)


def image_copies(images: DataFrame) -> DataFrame:
    """One row per row of images (image_id, pixels, and width and height if not square): image_id, component_id, n_links.

    component_id is the smallest image_id of the group, n_links the number of distinct other pictures it links to. Null and
    empty pixels are copies of each other only as equal bytes; a null image_id keeps a null component unless copies have
    one; repeated rows return as often as they occur; extra columns are not read; an empty table gives an empty table.
    The images are read once: a table of their hashes and keypoints is written to the shared folder.
    """
    rows = materialize(described(images), "described")
    nodes = materialize(rows.groupBy("h1", "h2").agg(F.min("image_id").alias("node")), "nodes")
    shown = rows.where("image_id IS NOT NULL").join(nodes.select(F.col("node").alias("image_id")), "image_id", "left_semi").dropDuplicates(["image_id", "h1", "h2"])
    linked = materialize(links(keypoints(shown)), "image-links")
    roots = components(linked)
    degree = linked.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = materialize(nodes.join(roots, "node", "left").join(degree, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "image-classes")
    return rows.select("image_id", "h1", "h2").join(named, ["h1", "h2"]).select("image_id", "component_id", "n_links")


def _drawn(e: np.ndarray, side: int) -> np.ndarray:
    """A sum of waves whose directions, lengths and phases swing fast with the vector's entries: other vectors, other textures."""
    at = np.arange(side) / side
    u, v, phase = 16 * np.sin(611 * e), 16 * np.sin(827 * e + 1), 2 * np.pi * np.modf(1013 * e)[0]
    return ((np.exp(2j * np.pi * np.outer(at, v) + 1j * phase)) @ np.exp(2j * np.pi * np.outer(u, at))).real


EDITS = ("crop", "bright", "noise", "shift", "turn", "smaller", "half", "strip")


def edited(picture: np.ndarray, edit: str, seed: int) -> np.ndarray:
    """An edited copy of a square picture."""
    side = len(picture)
    random, at = np.random.default_rng(seed), np.arange(side)
    if edit == "crop":
        return picture[side // 12 : -(side // 12), side // 12 : -(side // 12)]
    if edit == "half":
        a = (side - int(side * np.sqrt(0.5))) // 2
        return picture[a:-a, a:-a]
    if edit == "strip":
        return picture[side // 10 : -(side // 6), side // 24 : -(side // 24)]
    if edit == "bright":
        return np.clip(picture * 0.8 + 30, 0, 255)
    if edit == "noise":
        return np.clip(picture + random.normal(0, 10, picture.shape), 0, 255)
    if edit == "shift":
        moved = np.roll(picture, (9, 13), (0, 1))
        moved[:9] = moved[:, :13] = 128
        return moved
    if edit == "smaller":
        at = np.arange(side * 3 // 4) / 0.75
        return _between(_blur(picture[None]), np.zeros((1, 1), int), at[:, None] + 0 * at, at + 0 * at[:, None])
    angle, middle = np.deg2rad(15), (side - 1) / 2
    y, x = np.meshgrid(at - middle, at - middle, indexing="ij")
    v, u = middle + np.cos(angle) * y - np.sin(angle) * x, middle + np.sin(angle) * y + np.cos(angle) * x
    inside = (np.minimum(u, v) >= 0) & (np.maximum(u, v) <= side - 1)
    return np.where(inside, _between(picture[None], np.zeros(y.shape, int), v, u), 128)


def render(vectors: DataFrame, copy_each: int = 10, side: int = SIDE) -> DataFrame:
    """A media table from vectors (vec_id, embedding): image_id, vec_id, edit, width, height, pixels.

    Each vector is drawn as a sum of waves. Of each `copy_each`-th vec_id there is also an edited copy, of EDITS in turn.
    image_id is 2 * vec_id, and an odd number far from it for the copy. Null vectors draw a blank; rows without vec_id none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, 128) for b in batches for a in range(0, b.num_rows, 128)):
            rows = []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                e = np.nan_to_num(np.array([0.0 if x is None else x for x in vector or []]))
                if vec_id is None:
                    continue
                drawn = _drawn(e, side)
                base = np.clip(128 + 60 * drawn / max(drawn.std(), 1e-9), 0, 255).astype(np.float32)
                rows.append((2 * vec_id, vec_id, "none", base))
                if vec_id % copy_each == 0:
                    edit = EDITS[vec_id // copy_each % len(EDITS)]
                    rows.append((2 * (vec_id ^ 0x2BAD5) + 1, vec_id, edit, edited(base, edit, vec_id)))
            kinds, values = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()), [(*r[:3], r[3].shape[1], r[3].shape[0], r[3].astype(np.uint8).tobytes()) for r in rows]
            yield pa.record_batch([pa.array([v[i] for v in values], k) for i, k in enumerate(kinds)], names=["image_id", "vec_id", "edit", "width", "height", "pixels"])

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, "image_id long, vec_id long, edit string, width int, height int, pixels binary")
