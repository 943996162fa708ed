"""Licence scans: sparse TF-IDF cosine of licence statements to templates, then inheritance from the nearest directory.

Every sentence with a licence word is a statement. Distinct statements are scored once, however many files hold them, by
joining their terms with the weighted terms of the templates (a fixed, small table, broadcast). A file's own licence is
its best statement at LEAST similarity or more. Licence files, by name, give theirs to their directory; a file without
an own licence inherits that of the nearest ancestor directory that has one, found by joining the ancestor paths of the
distinct directories. Only built-in functions run.

Weights: term count times 1 + ln((1 + templates) / (1 + templates with the term)); terms outside the templates count in
a statement's length. Null texts hold no statement; null paths are in no directory and inherit nothing; repeated rows
of one path share what any of them states; an empty table gives an empty result.
"""

import math
from collections import Counter

from pyspark.sql import functions as F

from .frames import body, col, free_name, written

LEAST = 0.6
#: The usual short notices of common licences.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all rights under CC0 1.0 Universal Public Domain Dedication license."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "You can redistribute it and/or modify it under the terms of the GNU General Public License, version 2, as published by the Free Software Foundation."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "You can redistribute it and/or modify it under the terms of the GNU General Public License, version 3, as published by the Free Software Foundation."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, under the MIT License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."],
}
STATEMENT = r"(?i)licen[cs]e|creative commons|public domain"
SENTENCE = r"\n|(?<=[.!?])[ \t]+"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying)[^/]*$"


def terms(text):
    """Lower-case terms of letters, digits and inner dots."""
    return F.filter(F.transform(F.split(F.lower(text), r"[^a-z0-9.]+"), lambda t: F.btrim(t, F.lit("."))), lambda t: t != "")


def template_terms(spark, templates=TEMPLATES):
    """(template, licence, term, weight, idf): the unit vectors of all templates; a row per term."""
    texts = [(f"{name}/{k}", name, t) for name, ts in templates.items() for k, t in enumerate(ts)]
    words = {i: Counter(w.strip(".") for w in "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789." else " " for c in t.lower()).split() if w.strip(".")) for i, _, t in texts}
    df = Counter(w for c in words.values() for w in c)
    idf = {w: 1 + math.log((1 + len(texts)) / (1 + n)) for w, n in df.items()}
    rows = []
    for i, name, _ in texts:
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in words[i].items()))
        rows += [(i, name, w, n * idf[w] / norm, idf[w]) for w, n in words[i].items()]
    return spark.createDataFrame(rows, "template string, licence string, term string, weight double, idf double"), 1 + math.log(1 + len(texts))


def matched(statements, templates=TEMPLATES, least=LEAST):
    """(statement, licence, score) of each distinct statement that is like a template."""
    table, unknown = template_terms(statements.sparkSession, templates)
    table = F.broadcast(table)
    counted = statements.select("statement", F.explode(terms(F.col("statement"))).alias("term")).groupBy("statement", "term").agg(F.count("*").alias("n"))
    known = F.broadcast(table.select("term", "idf").distinct())
    weighed = written(counted.join(known, "term", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(unknown))).drop("idf"), "terms")
    length = weighed.groupBy("statement").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dot = weighed.join(table.drop("idf"), "term").groupBy("statement", "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dot.join(length, "statement").withColumn("score", F.round(F.col("dot") / F.col("length"), 9)).where(F.col("score") >= least)
    best = scored.groupBy("statement").agg(F.min_by("licence", F.struct(-F.col("score"), F.col("licence"))).alias("licence"), F.max("score").alias("score"))
    return best


def parent(path):
    """The directory of a path, '' for the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def nearest(dirs, licensed):
    """(dir, from_dir, inherited): the nearest of a directory and its ancestors that has a licence."""
    parts = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.when(n == 0, "").otherwise(F.array_join(F.slice(parts, 1, F.greatest(n, F.lit(1))), "/")).alias("up")))
    each = dirs.select("dir", F.explode(ups).alias("u")).select("dir", "u.*")
    found = each.join(licensed.select(F.col("dir").alias("up"), "licence"), "up")
    return found.groupBy("dir").agg(F.max_by("up", "depth").alias("from_dir"), F.max_by("licence", "depth").alias("inherited"))


def scan(files, path="path", text="text", carry=None, templates=TEMPLATES, least=LEAST):
    """The columns of carry (default: all of files) and a struct of licence, score, how ('own', 'inherited' or null) and
    from_dir; also returns the struct's name."""
    carry = list(files.columns if carry is None else carry)
    name = free_name(files, "licence")
    sentences = F.filter(F.split(body(text), SENTENCE), lambda s: s.rlike(STATEMENT))
    said = written(files.where(body(text).rlike(STATEMENT)).select(col(path).alias("path_"), F.explode(sentences).alias("statement")), "statements")
    best = written(matched(said.select("statement").distinct(), templates, least), "matched")
    top = F.min_by(F.struct("licence", "score"), F.struct(-F.col("score"), F.col("licence")))
    own = written(said.join(best, "statement").groupBy("path_").agg(top.alias("own")), "own")
    licensed = own.where(F.col("path_").rlike(LICENCE_FILE)).select(parent(F.col("path_")).alias("dir"), F.col("own")).groupBy("dir").agg(F.min_by("own.licence", F.struct(-F.col("own.score"), F.col("own.licence"))).alias("licence"))
    dirs = files.where(col(path).isNotNull()).select(parent(col(path)).alias("dir")).distinct()
    given = written(nearest(dirs, licensed), "inherited")
    rows = files.select(*map(col, carry), col(path).alias("at_"), parent(col(path)).alias("in_"))
    rows = rows.join(own, F.col("at_").eqNullSafe(F.col("path_")), "left").join(given, F.col("in_") == F.col("dir"), "left")
    how = F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited")
    found = F.struct(F.coalesce("own.licence", "inherited").alias("licence"), F.col("own.score").alias("score"), how.alias("how"), F.when(how == "inherited", F.col("from_dir")).alias("from_dir"))
    return rows.select(*map(col, carry), found.alias(name)), name
