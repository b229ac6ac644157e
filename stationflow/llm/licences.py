"""Licence scan with a positional index of licence words.

Templates are the usual notices of a licence, as word sequences.  One corpus
pass splits every text and keeps the distinct template words it holds, which give
every word its IDF over the whole corpus, and the positions of licence words.
Then each template's highest-IDF words alone are looked up: where one stands, the
relative position (place in the file minus place in the template) is a candidate
notice if the file holds a mandatory key phrase of the label.  A candidate's other
words are intersected with the file's by position, and it becomes a label if they
carry ``COVER`` of the template's IDF.  So many rare words are looked up that a
place without any of them can't reach ``COVER``.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm.scratch import Scratch
from stationflow.llm.words import lower_ascii, split_words, word_count

COVER = 0.6
#: IDFs are added as whole numbers of this fraction, so that no sum depends on its order.
UNIT = 1e-9

# Base phrases with their labels, notices, and the key phrases of which a label needs one.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("cc", "this work is licensed under a creative commons attribution license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights "
     "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
     "whom the software is furnished to do so subject to the following conditions"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
     "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option any "
     "later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
     "general public license as published by the free software foundation either version 2 1 of the license or at your "
     "option any later version"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
     "general public license as published by the free software foundation either version 3 of the license or at your "
     "option any later version"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify "
     "publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
     "purpose commercial or non commercial and by any means"),
    ("cc", "this work is licensed under the creative commons attribution 4 0 international license to view a copy of this "
     "license visit http creativecommons org licenses by 4 0"),
)
KEY_PHRASES = (
    ("mit", "mit license"), ("mit", "permission is hereby granted"),
    ("apache", "apache license"), ("apache", "compliance with the license"),
    ("gpl", "gnu general public license"),
    ("lgpl", "lesser general public license"),
    ("agpl", "affero general public license"),
    ("mpl", "mozilla public license"),
    ("bsd", "source and binary forms"),
    ("isc", "permission to use copy modify"),
    ("cc", "creative commons"),
    ("unlicense", "unencumbered software"),
)


def _postings(spark: SparkSession) -> DataFrame:
    """(kind, entry, label, off, word, len) of templates, key phrases and base phrases: a few hundred rows."""
    rows = []
    for kind, entries in (
        ("template", TEMPLATES),
        ("key", KEY_PHRASES),
        ("base", [(label, phrase) for phrase, label in BASE]),
    ):
        for entry, (label, text) in enumerate(entries):
            words = text.split()
            rows += [(kind, entry, label, off, word, len(words)) for off, word in enumerate(words)]
    return spark.createDataFrame(rows, "kind string, entry int, label string, off int, word string, len int")


def _phrases() -> list[str]:
    return sorted({p for p, _ in BASE} | {p for _, p in KEY_PHRASES})


def licence_words(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(rid, doc_id, n_words, held, found) of every document, whose text is split once.

    ``held``: the distinct template words of the text.  ``found``: positions of the
    words of templates and phrases, from 0.  A label needs a phrase of ``BASE`` or
    ``KEY_PHRASES``, so documents that don't hold all words of any of them keep no
    positions; their words are counted all the same.
    """
    names = sorted({w for _, t in TEMPLATES for w in t.split()} | {w for p in _phrases() for w in p.split()})
    words = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", split_words(lower_ascii(F.col("text"))).alias("words")
    )
    held = words.withColumn("held", F.array_intersect(F.array(*(F.lit(w) for w in names)), "words"))
    may = F.lit(False)
    for phrase in _phrases():
        # the words of one phrase: a handful
        may = may | (F.size(F.array_except(F.array(*(F.lit(w) for w in phrase.split())), "held")) == 0)
    at = F.transform("words", lambda w, i: F.struct((i - 1).alias("pos"), w.alias("word")))
    found = F.filter(at, lambda e: e["word"].isin(names))
    empty = F.array().cast("array<struct<pos:int,word:string>>")
    return scratch.table(
        held.select(
            "rid", "doc_id", word_count(F.col("words")).alias("n_words"), "held", F.when(may, found).otherwise(empty).alias("found")
        ),
        "words",
    )


def idf_weights(table: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, idf) of every template word, from its document frequency over all rows of ``licence_words``."""
    spark = table.sparkSession
    names = sorted({w for _, t in TEMPLATES for w in t.split()})
    df = table.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    n = table.count()
    every = spark.createDataFrame([(w,) for w in names], "word string")
    idf = F.log((F.lit(n) + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1e-3
    return scratch.table(every.join(df, "word", "left").select("word", idf.alias("idf")).coalesce(1), "idf")


def rare_words(postings: DataFrame, idf: DataFrame) -> DataFrame:
    """(entry, label, off, word, idf, total, rare) of the templates' words; ``idf`` in units.

    ``rare`` marks a template's highest-IDF words, as many as carry more than
    ``1 - COVER`` of its IDF: a place that has none of them in position can't reach
    ``COVER``, so looking up these alone loses no notice.
    """
    weighted = postings.where("kind = 'template'").drop("kind", "len").join(idf, "word")
    weighted = weighted.withColumn("idf", F.round(F.col("idf") / UNIT).cast("long"))
    order = Window.partitionBy("entry").orderBy(F.desc("idf"), "off")
    before = F.coalesce(F.sum("idf").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("idf").over(Window.partitionBy("entry"))
    # a unit more, for what the shares' doubles round away
    rare = F.col("before") <= F.floor((1 - COVER) * F.col("total")) + 1
    return weighted.withColumns({"before": before, "total": total}).withColumn("rare", rare).drop("before")


def licences(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    Columns: doc_id, n_words, n_base (places where the words of a base phrase
    stand consecutively), first_word and last_word (smallest and largest start
    of these, words from 0, null without any), base_labels, labels (the
    templates' too; distinct, sorted, comma-joined, empty without any), score
    (0 to 1: 1 with a base phrase, else the best share of a template's IDF found
    at a place where one of its rare words stands, with a key phrase; 0 without).

    A null or empty text has no words and no labels.  Repeated rows and rows
    with a null ``doc_id`` each get their row.  Further columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licences")
    docs = docs.select("doc_id", "text")
    table = licence_words(docs, scratch)
    idf = idf_weights(table, scratch)
    postings = _postings(spark)
    n_entries = postings.count()  # fixed by the tables above
    assert n_entries < 1000, "the postings are broadcast"

    found = table.where(F.size("found") > 0).select("rid", F.explode("found").alias("f")).select("rid", "f.pos", "f.word")
    phrases = postings.where("kind <> 'template'")
    whole = (
        found.join(F.broadcast(phrases), "word")
        .groupBy("rid", "kind", "entry", "label", "len", (F.col("pos") - F.col("off")).alias("start"))
        .agg(F.count_distinct("off").alias("n"))
        .where("n = len")
    )
    whole = scratch.table(whole.select("rid", "kind", "label", "start"), "phrases")
    base = whole.where("kind = 'base'").groupBy("rid").agg(
        F.count("*").alias("n_base"),
        F.min("start").cast("long").alias("first_word"),
        F.max("start").cast("long").alias("last_word"),
        F.collect_set("label").alias("base"),
    )

    weighted = scratch.table(rare_words(postings, idf).coalesce(1), "weights")
    rare = weighted.where("rare").select("word", "entry", "label", "total", "off")
    candidates = (
        found.join(F.broadcast(rare), "word")
        .select("rid", "entry", "label", "total", (F.col("pos") - F.col("off")).alias("start"))
        .distinct()
    )
    keys = whole.where("kind = 'key'").select("rid", "label").distinct()
    candidates = scratch.table(candidates.join(keys, ["rid", "label"]), "candidates")
    expected = candidates.join(F.broadcast(weighted.select("entry", "off", "word", "idf")), "entry").select(
        "rid", "entry", "label", "total", "start", (F.col("start") + F.col("off")).alias("pos"), "word", "idf"
    )
    covered = (
        expected.join(found, ["rid", "pos", "word"])
        .groupBy("rid", "entry", "label", "total", "start")
        .agg(F.sum("idf").alias("idf"))
        .withColumn("cover", F.col("idf") / F.col("total"))
    )
    by_template = covered.groupBy("rid").agg(
        F.collect_set(F.when(F.col("cover") >= COVER, F.col("label"))).alias("more"), F.max("cover").alias("cover")
    )
    none = F.array().cast("array<string>")
    own = F.coalesce("base", none)
    joined = table.select("rid", "doc_id", "n_words").join(base, "rid", "left").join(by_template, "rid", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.concat_ws(",", F.array_sort(own)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(own, F.coalesce("more", none)))).alias("labels"),
        F.when(F.size(own) > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
