"""Licence notices by Dice coefficient over word bigrams, on SQL expressions alone.

Each line of a text, and the text as a whole, is normalised to lower-case words and
compared with every template whose size allows the wanted likeness: with ``a`` and
``b`` distinct bigrams, the coefficient is at most ``2 * min(a, b) / (a + b)``. Few
lines pass that bound, and only their bigrams are intersected.

Defined cases: null, empty and wordless texts match nothing; one-word lines have that
word as their only bigram; equal lines count each; other columns pass through, and a
clash with ``out`` raises ``ValueError``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8  # coefficient from which on a line is a notice of the licence

# Public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "Released into the public domain under CC0 1.0 Universal.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
}


def words_of(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), "[^0-9a-z]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words of a column of words."""
    pairs = F.transform(
        words, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))
    )
    return F.array_distinct(F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))))


def _bounds(n: int, least: float) -> tuple[float, float]:
    return n * least / (2 - least), n * (2 - least) / least


def template_bigrams(templates: dict[str, str]) -> dict[str, list[str]]:
    import re

    out = {}
    for name, text in templates.items():
        words = re.findall("[0-9a-z]+", text.lower())
        pairs = [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))]
        out[name] = list(dict.fromkeys(pairs)) if words else []
    return out


def with_notices(
    docs: DataFrame,
    out: str = "notices",
    text: str = "text",
    templates: dict[str, str] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """``docs`` with an array of ``(line, licence, dice)``, one for each line and
    template at least ``least`` alike; the whole text is line -1 where it has several.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    known = {k: v for k, v in template_bigrams(templates).items() if v}
    sizes = [len(v) for v in known.values()]
    low = min((_bounds(n, least)[0] for n in sizes), default=0)
    high = max((_bounds(n, least)[1] for n in sizes), default=-1)
    clash = "_units"
    while clash in docs.columns:
        clash += "_"
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.transform(
        F.split(body, "\n", -1), lambda x, i: F.struct(i.alias("line"), words_of(x).alias("w"))
    )
    whole = F.when(
        F.contains(body, F.lit("\n")),
        F.array(F.struct(F.lit(-1).alias("line"), words_of(body).alias("w"))),
    ).otherwise(F.array().cast("array<struct<line:int,w:array<string>>>"))
    # Distinct words are at most one more than distinct bigrams.
    fits = F.filter(
        F.concat(lines, whole),
        lambda u: (F.size(u["w"]) >= F.greatest(F.lit(low), F.lit(1)))
        & (F.size(F.array_distinct(u["w"])) <= F.lit(high + 1)),
    )
    units = docs.withColumn(clash, fits)
    paired = F.transform(
        F.col(clash),
        lambda u: F.struct(u["line"].alias("line"), _bigrams(u["w"]).alias("b")),
    )
    scored = F.flatten(
        F.transform(
            paired,
            lambda u: F.array(
                *(
                    F.struct(
                        u["line"].alias("line"),
                        F.lit(name).alias("licence"),
                        F.when(
                            (F.size(u["b"]) >= _bounds(len(b), least)[0])
                            & (F.size(u["b"]) <= _bounds(len(b), least)[1]),
                            2.0
                            * F.size(F.array_intersect(u["b"], F.array(*map(F.lit, b))))
                            / (F.size(u["b"]) + len(b)),
                        ).otherwise(0.0).alias("dice"),
                    )
                    for name, b in known.items()
                )
            ),
        )
    )
    return units.withColumn(out, F.filter(scored, lambda r: r["dice"] >= least)).drop(clash)
