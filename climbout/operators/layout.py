"""Placing labels one after another: each takes its cheapest candidate beside what is drawn and what was placed before it.

An airport's labels are one array and are folded in their order; the state is the boxes placed so far, so each placed box is
clutter for the next label.  What is drawn (boxes, lines, areas) joins by airport; no row holds more than an airport.  The airports of a
batch are folded side by side: the first labels of all, then the second ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy

# Size of a character and a line, gap, growth when zoomed out, and the costs of clutter.
CHAR_NM, LINE_NM, LABEL_GAP_NM, STEP_NM, ZOOM = 0.16, 0.32, 0.1, 0.25, 1.6
OVERLAP, MARGIN, LINE_COST, RADIAL_COST, AREA_COST, OFF_MIDDLE = 100.0, 20.0, 4.0, 1.0, 3.0, 0.005
NOTE_REACH_NM, NOTE_STEP_DEG = 2.0, 15
# Pairs of a spot and what lies there that are priced at a time.
PAIRS = 500_000


def half_size(texts: Column) -> Column:
    """struct<w, h>: half the width and height of lines stacked as one block."""
    return F.struct((F.array_max(F.transform(texts, F.char_length)) * CHAR_NM / 2).alias("w"), ((F.size(texts) + 1) * LINE_NM / 2).alias("h"))


def lines_at(x: Column, y: Column, texts: Column) -> Column:
    """array<struct<text, x, y>>: where each line of a block stands, top first."""
    return F.transform(texts, lambda t, i: F.struct(t.alias("text"), x.alias("x"), (y + ((F.size(texts) - 1) / 2 - i) * LINE_NM).alias("y")))


def beyond(x: Column, y: Column, reach: Column, bearing: Column, w: Column, h: Column) -> Column:
    """struct<x, y>: the centre of a box whose near edge lies just beyond reach on a bearing."""
    ux, uy = F.abs(F.sin(F.radians(bearing))), F.abs(F.cos(F.radians(bearing)))
    edge = F.least(F.coalesce(w / F.nullif(ux, F.lit(0.0)), F.lit(1e9)), F.coalesce(h / F.nullif(uy, F.lit(0.0)), F.lit(1e9)))
    return geodesy.offset(x, y, bearing, reach + LABEL_GAP_NM + edge)


def fan_candidates(x: Column, y: Column, radius: Column, bearings: Column, w: Column, h: Column) -> Column:
    """array<struct<x, y, cost>> for a fan's label: inside it at every reach on every bearing, then just beyond its arc.

    The cost is the distance from the apex and, slightly, the angle from the middle of the sector.
    """
    reaches = F.transform(F.sequence(F.lit(1), F.greatest(F.floor(radius / STEP_NM).cast("int"), F.lit(1))), lambda i: i * STEP_NM)

    def on(b: Column) -> Column:
        spots = F.concat(F.transform(F.filter(reaches, lambda r: r <= radius), lambda r: geodesy.offset(x, y, b["bearing"], r)), F.array(beyond(x, y, radius, b["bearing"], w, h)))
        cost = lambda p: F.sqrt(F.pow(p["x"] - x, 2) + F.pow(p["y"] - y, 2)) + OFF_MIDDLE * F.abs(b["off"])
        return F.transform(spots, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), cost(p).alias("cost")))

    return F.flatten(F.transform(bearings, on))


def note_candidates(x: Column, y: Column) -> Column:
    """array<struct<x, y, cost>> for a note near an airport: ever farther rings of bearings, from south round."""
    reaches = [i * STEP_NM for i in range(2, int(NOTE_REACH_NM / STEP_NM) + 1)]
    return F.array(*[F.struct((x + r * F.sin(F.radians(F.lit(float(b))))).alias("x"), (y + r * F.cos(F.radians(F.lit(float(b))))).alias("y"), F.lit(r).alias("cost")) for r in reaches for b in range(180, 540, NOTE_STEP_DEG)])


def box_cost(p: np.ndarray, o: np.ndarray) -> np.ndarray:
    """What boxes p (rows x, y, w, h) share with boxes o, and would share zoomed out: two terms each; nulls are NaN and count as no edge."""

    def shared(z: float) -> np.ndarray:
        side = lambda c, half: np.fmax(np.fmin(p[c] + z * p[half], o[c] + z * o[half]) - np.fmax(p[c] - z * p[half], o[c] - z * o[half]), 0.0)
        return side(0, 2) * side(1, 3)

    return np.stack([OVERLAP * shared(1.0), MARGIN * shared(ZOOM)], axis=1)


def line_cost(p: np.ndarray, o: np.ndarray) -> np.ndarray:
    """The weighted lengths of lines o (rows x0, y0, x1, y1, weight) inside boxes p, as `geodesy.clipped_length`: one term each."""
    dx, dy = o[2] - o[0], o[3] - o[1]

    def interval(c: int, d: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = p[c] - p[half], p[c] + p[half]
        within = (o[c] >= lo) & (o[c] <= hi)
        one, two = (lo - o[c]) / d, (hi - o[c]) / d
        return np.where(d == 0, np.where(within, 0.0, 2.0), np.fmin(one, two)), np.where(d == 0, np.where(within, 1.0, -1.0), np.fmax(one, two))

    with np.errstate(divide="ignore", invalid="ignore"):
        (ex, lx), (ey, ly) = interval(0, dx, 2), interval(1, dy, 3)
    share = np.fmin(np.fmin(lx, ly), 1.0) - np.fmax(np.fmax(ex, ey), 0.0)
    return (o[4] * (np.fmax(share, 0.0) * np.sqrt(dx * dx + dy * dy)))[:, None]


def summed(price, spots: np.ndarray, things: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """For each of the spots (columns) the sum of price(spot, thing) over its `count` things from `start`, added in their order, PAIRS at a time."""
    out, ends = np.zeros(len(start)), np.cumsum(count)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, side="right")))
        n = count[i:j]
        spot = np.repeat(np.arange(i, j), n)
        thing = np.arange(len(spot)) + np.repeat(start[i:j] - np.cumsum(n) + n, n)
        terms = price(spots[:, spot], things[:, thing])
        out[i:j] = np.bincount(np.repeat(spot - i, terms.shape[1]), terms.ravel(), j - i)
        i = j
    return out


def rounded(x: np.ndarray) -> np.ndarray:
    """Nine decimals, halves away from zero; larger values have no more of them."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.where(np.abs(x) < 4e6, np.copysign(np.floor(np.abs(x) * 1e9 + 0.5) / 1e9, x) + 0.0, x)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one after another."""
    return np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)


def lists(column: pa.ListArray, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, dict[str, pa.Array]]:
    """(start, count, fields) of a column of arrays of structs."""
    flat = column.flatten()
    at = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
    fields = dict(zip([f.name for f in flat.type], flat.flatten()))
    return at[:-1], np.diff(at), {n: fields[n] for n in names}


def doubles(fields: dict[str, pa.Array], names: tuple[str, ...]) -> np.ndarray:
    return np.stack([fields[n].cast(pa.float64()).to_numpy(zero_copy_only=False) for n in names])


def settled(batch: pa.RecordBatch, first_free: bool) -> pa.RecordBatch:
    """The rows of `place` for a batch (lid, _labels, _boxes, _lines), one airport a row."""
    first, labels, of = lists(batch.column("_labels"), ("seq", "w", "h", "spots"))
    seq = of["seq"].cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(labels)), labels)
    if np.any((owner[1:] == owner[:-1]) & (seq[1:] < seq[:-1])):
        order = pa.array(np.lexsort((seq, owner)))
        of = {name: values.take(order) for name, values in of.items()}
    spot_at, spot_n, spots = lists(of["spots"], ("x", "y", "cost"))
    size, spot = doubles(of, ("w", "h")), doubles(spots, ("x", "y", "cost"))
    box_at, boxes, box = lists(batch.column("_boxes"), ("x", "y", "w", "h"))
    line_at, lines, line = lists(batch.column("_lines"), ("x0", "y0", "x1", "y1", "weight"))
    ink = doubles(line, ("x0", "y0", "x1", "y1", "weight"))
    # boxes of an airport: what is drawn, then room for each of its labels
    room = np.cumsum(boxes + labels) - boxes - labels
    taken, filled = np.empty((4, int((boxes + labels).sum()))), boxes.copy()
    taken[:, ranges(room, boxes)] = doubles(box, ("x", "y", "w", "h"))
    absent = spots["x"].is_null().to_numpy(zero_copy_only=False)
    unknown = spots["cost"].is_null().to_numpy(zero_copy_only=False)
    blank = np.zeros(len(lines), bool)
    for name in line.values():
        blank[np.repeat(np.arange(len(lines)), lines)[name.is_null().to_numpy(zero_copy_only=False)]] = True
    best, cost = np.full(len(size[0]), -1), np.zeros(len(size[0]))
    for step in range(int(labels.max(initial=0))):
        here = np.flatnonzero(labels > step)
        here = here[spot_n[first[here] + step] > 0]
        label = first[here] + step
        n = spot_n[label]
        at, airport = ranges(spot_at[label], n), np.repeat(here, n)
        p = np.concatenate([spot[:2, at], size[:, np.repeat(label, n)]])
        shares = summed(box_cost, p, taken, room[airport], filled[airport])
        if first_free:
            total, key = spot[2, at], np.where(shares == 0, 0.0, 1.0)
            null = unknown[at]
        else:
            total = rounded(spot[2, at] + shares + summed(line_cost, p, ink, line_at[airport], lines[airport]))
            null = unknown[at] | blank[airport]
            key = np.where(null, -np.inf, np.where(np.isnan(total), np.inf, total))
        starts = np.cumsum(n) - n
        least = np.minimum.reduceat(key, starts) if len(starts) else key
        hits = np.flatnonzero(key == np.repeat(least, n))
        pick = hits[np.searchsorted(hits, starts)]
        if first_free:
            free = least == 0
            here, label, pick = here[free], label[free], pick[free]
        best[label], cost[label] = at[pick], np.where(null[pick], np.nan, total[pick])
        drawn = ~absent[at[pick]]
        here, pick = here[drawn], pick[drawn]
        taken[:, room[here] + filled[here]] = p[:, pick]
        filled[here] += 1
    index = pa.array(best, mask=best < 0)
    lost = best < 0
    lost[~lost] = np.isnan(cost[~lost])
    where = [spots[c].cast(pa.float64()).take(index) for c in ("x", "y")]
    return pa.RecordBatch.from_arrays([batch.column("lid").take(pa.array(owner)), of["seq"].cast(pa.int64()), *where, pa.array(cost, mask=lost)], names=["lid", "seq", "x", "y", "cost"])


def place(labels: DataFrame, boxes: DataFrame, lines: DataFrame, first_free: bool = False) -> DataFrame:
    """(lid, seq, x, y, cost) of labels(lid, seq, w, h, spots array<struct<x, y, cost>>), placed in order of seq.

    boxes(lid, x, y, w, h) and lines(lid, x0, y0, x1, y1, weight) are what is drawn.  The cheapest spot wins, the first of them on ties.
    first_free takes the first spot that shares nothing with a box instead, and null where there is none.
    """
    d = lambda c: F.col(c).cast("double").alias(c)
    rows = labels.groupBy("lid").agg(F.collect_list(F.struct("seq", d("w"), d("h"), "spots")).alias("_labels"))
    drawn = boxes.groupBy("lid").agg(F.collect_list(F.struct(*map(d, ("x", "y", "w", "h")))).alias("_boxes"))
    inked = lines.groupBy("lid").agg(F.collect_list(F.struct(*map(d, ("x0", "y0", "x1", "y1", "weight")))).alias("_lines"))
    # merge joins: a broadcast would pass all that is drawn through the driver
    rows = rows.join(drawn.hint("merge"), "lid", "left").join(inked.hint("merge"), "lid", "left").select("lid", "_labels", "_boxes", "_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield settled(batch, first_free)

    return rows.mapInArrow(run, f"lid {labels.schema['lid'].dataType.simpleString()}, seq long, x double, y double, cost double")
