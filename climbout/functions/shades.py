"""Shades of a KML colour (aabbggrr) as Column expressions, through lightness, chroma and hue of OKLCH."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geodesy import let, wrap180

# Degrees of hue and share of chroma that shades may move, colours that can be taken for each other, step into the gamut.
HUE_SPREAD, LEAST_CHROMA, NEIGHBOUR_SHARE, ALIKE, TWO_ROWS = 15.0, 0.6, 1 / 3, 0.6, 4
GAMUT_STEP, GAMUT_SLACK = 0.002, 1e-4
# The published matrices of linear sRGB to cone responses, cone responses to OKLab, and back.
TO_CONES = ((0.4122214708, 0.5363325363, 0.0514459929), (0.2119034982, 0.6806995451, 0.1073969566), (0.0883024619, 0.2817188376, 0.6299787005))
TO_LAB = ((0.2104542553, 0.7936177850, -0.0040720468), (1.9779984951, -2.4285922050, 0.4505937099), (0.0259040371, 0.7827717662, -0.8086757660))
FROM_LAB = ((1.0, 0.3963377774, 0.2158037573), (1.0, -0.1055613458, -0.0638541728), (1.0, -0.0894841775, -1.2914855480))
TO_RGB = ((4.0767416621, -3.3077115913, 0.2309699292), (-1.2684380046, 2.6097574011, -0.3413193965), (-0.0041960863, -0.7034186147, 1.7076147010))


def product(matrix: tuple, vector: Column) -> Column:
    """The matrix times an array of three."""
    return F.array(*[functools.reduce(lambda a, b: a + b, [F.lit(m) * vector[i] for i, m in enumerate(row)]) for row in matrix])


def oklch(colour: Column) -> Column:
    """struct<l, c, h> of a KML colour."""
    channel = lambda at: F.conv(F.substring(colour, at, 2), 16, 10).cast("double") / 255
    linear = F.transform(F.array(channel(7), channel(5), channel(3)), lambda v: F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4))))
    polar = lambda v: F.struct(v["lab"][0].alias("l"), F.hypot(v["lab"][1], v["lab"][2]).alias("c"), F.degrees(F.atan2(v["lab"][2], v["lab"][1])).alias("h"))
    lab = lambda v: let(polar, lab=product(TO_LAB, v["cones"]))
    return let(lambda v: let(lab, cones=F.transform(product(TO_CONES, v["rgb"]), F.cbrt)), rgb=linear)


def linear_rgb(lightness: Column, chroma: Column, hue: Column) -> Column:
    """array of linear red, green and blue; outside of 0 to 1 if the colour cannot be shown."""
    lab = F.array(lightness, chroma * F.cos(F.radians(hue)), chroma * F.sin(F.radians(hue)))
    cubes = lambda v: let(lambda w: product(TO_RGB, w["c"]), c=F.transform(product(FROM_LAB, v["lab"]), lambda x: x * x * x))
    return let(cubes, lab=lab)


def shown(lightness: Column, chroma: Column, hue: Column) -> Column:
    """Linear channels of the colour with the most chroma, in steps down from the one asked for, that can be shown."""
    steps = F.sequence(F.lit(0), F.ceil(F.greatest(chroma, F.lit(0.0)) / GAMUT_STEP).cast("int"))
    tried = F.transform(steps, lambda i: linear_rgb(lightness, chroma - i * GAMUT_STEP, hue))
    fits = F.filter(tried, lambda rgb: F.forall(rgb, lambda v: v.between(-GAMUT_SLACK, 1 + GAMUT_SLACK)))
    return let(lambda v: F.coalesce(F.try_element_at(v["fits"], F.lit(1)), F.try_element_at(v["tried"], F.lit(-1))), fits=fits, tried=tried)


def kml(rgb: Column, alpha: Column) -> Column:
    """aabbggrr of linear channels."""
    gamma = lambda v: F.when(v <= 0.0031308, 12.92 * v).otherwise(1.055 * F.pow(v, F.lit(1 / 2.4)) - 0.055)
    pair = F.transform(F.reverse(rgb), lambda v: F.lpad(F.lower(F.hex(F.bround(255 * gamma(F.greatest(F.least(v, F.lit(1.0)), F.lit(0.0)))).cast("int"))), 2, "0"))
    return F.concat(alpha, F.array_join(pair, ""))


def visiting(count: Column) -> Column:
    """0 to count - 1 in an order that keeps neighbours apart: by the least stride above half that meets every place."""
    meets = lambda s: ~F.exists(F.sequence(F.lit(2), F.greatest(count, F.lit(2))), lambda d: (F.pmod(s, d) == 0) & (F.pmod(count, d) == 0))
    half = F.floor(count / 2).cast("int")
    stride = F.when(count > 2, F.filter(F.sequence(half + 1, F.greatest(count - 1, half + 1)), meets)[0]).otherwise(1)
    return let(lambda v: F.transform(F.sequence(F.lit(0), v["n"] - 1), lambda i: F.pmod(i * v["stride"], v["n"])), n=count, stride=stride)


def hue_room(own: Column, others: list[Column]) -> tuple[Column, Column]:
    """How far the hue may move down and up before it comes near one of the others of comparable chroma."""
    near = [F.least(own["c"], o["c"]) >= ALIKE * F.greatest(own["c"], o["c"]) for o in others]
    gaps = [wrap180(o["h"] - own["h"]) for o in others]
    below = [F.when(n & (g < 0), -g * NEIGHBOUR_SHARE).otherwise(HUE_SPREAD) for n, g in zip(near, gaps)]
    above = [F.when(n & (g > 0), g * NEIGHBOUR_SHARE).otherwise(HUE_SPREAD) for n, g in zip(near, gaps)]
    widest = F.lit(HUE_SPREAD)
    return F.least(widest, widest, *below), F.least(widest, widest, *above)


def shades(colour: Column, count: Column, palette: tuple[str, ...]) -> Column:
    """array of `count` colours around one of a palette, none to be mistaken for another of it; consecutive ones far apart."""
    count = count.cast("int")

    def around(v: Column) -> Column:
        rows = F.when(v["n"] >= TWO_ROWS, 2).otherwise(1)
        columns = F.ceil(v["n"] / rows).cast("int")

        def one(place: Column) -> Column:
            row, column = F.floor(place / columns), F.pmod(place, columns)
            hue = v["own"]["h"] + F.when(columns > 1, (v["below"] + v["above"]) * column / F.greatest(columns - 1, F.lit(1)) - v["below"]).otherwise(0.0)
            return kml(shown(v["own"]["l"], v["own"]["c"] * (1 - (1 - LEAST_CHROMA) * row), hue), F.substring(v["colour"], 1, 2))

        return F.transform(visiting(v["n"]), one)

    def limits(v: Column) -> Column:
        below, above = hue_room(v["own"], [v["others"][i] for i in range(len(palette))])
        return let(around, own=v["own"], below=below, above=above, n=v["n"], colour=v["colour"])

    # The colour itself is among the others, with a gap of nothing, which limits neither side.
    several = let(limits, own=oklch(colour), others=F.array(*[oklch(F.lit(p)) for p in palette]), n=count, colour=colour)
    return F.when(count > 1, several).when(count == 1, F.array(colour)).otherwise(F.expr("cast(array() as array<string>)"))
