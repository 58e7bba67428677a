"""Licence notices by ordered signature rules, in DataFrame functions only.

A text is brought to lower-case words joined by single spaces. A rule is a
regular expression over such words with a keyword that has to occur first, a
priority and a confidence; some hundred rules follow from the tables below, one
for each name of a licence and each form of notice. Of two detections of which
one contains the other, the contained one goes unless its priority is higher;
of two with the same place, the one with the higher priority stays, then the
earlier rule. Base phrases are found by the same matcher and always stay.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label: names as they stand in running text, as regular expressions over words.
NAMES = {
    "mit": [r"mit(?: x11)? licen[cs]e", r"expat licen[cs]e"],
    "apache-2": [r"apache licen[cs]e(?: version)? 2(?: 0)?", r"apache 2(?: 0)? licen[cs]e"],
    "apache-1.1": [r"apache(?: software)? licen[cs]e(?: version)? 1 1"],
    "gpl-2": [r"(?:gnu )?general public licen[cs]e(?: version| v)? ?2(?: 0)?", r"gnu gpl(?: version| v)? ?2(?: 0)?"],
    "gpl-3": [r"(?:gnu )?general public licen[cs]e(?: version| v)? ?3(?: 0)?", r"gnu gpl(?: version| v)? ?3(?: 0)?"],
    "lgpl-2.1": [r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1", r"gnu lgpl(?: version| v)? ?2 1"],
    "lgpl-3": [r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?", r"gnu lgpl(?: version| v)? ?3(?: 0)?"],
    "agpl-3": [r"(?:gnu )?affero general public licen[cs]e(?: version| v)? ?3(?: 0)?", r"gnu agpl(?: version| v)? ?3(?: 0)?"],
    "bsd-2": [r"(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e", r"bsd 2 clause licen[cs]e"],
    "bsd-3": [r"(?:new|revised|modified|3 clause|three clause) bsd licen[cs]e", r"bsd 3 clause licen[cs]e"],
    "mpl-2": [r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"],
    "mpl-1.1": [r"mozilla public licen[cs]e(?: version| v)? ?1 1"],
    "epl-1": [r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"],
    "epl-2": [r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"],
    "cddl-1": [r"common development and distribution licen[cs]e(?: version)?(?: 1(?: 0)?)?"],
    "isc": [r"isc licen[cs]e"],
    "zlib": [r"zlib(?: libpng)? licen[cs]e"],
    "boost-1": [r"boost software licen[cs]e(?: version)?(?: 1(?: 0)?)?"],
    "artistic-2": [r"artistic licen[cs]e(?: version)? 2(?: 0)?"],
    "wtfpl": [r"do what the fuck you want to public licen[cs]e"],
    "unlicense": [r"the unlicense"],
    "cc0-1": [r"creative commons(?: cc0| zero)(?: universal)?(?: 1(?: 0)?)?", r"cc0(?: 1(?: 0)?)? licen[cs]e"],
    "cc-by": [r"creative commons attribution(?: \d(?: \d)?)?", r"cc by(?: \d(?: \d)?)"],
    "cc-by-sa": [r"creative commons attribution share ?alike(?: \d(?: \d)?)?", r"cc by sa(?: \d(?: \d)?)?"],
    "cc-by-nc": [r"creative commons attribution non ?commercial(?: \d(?: \d)?)?", r"cc by nc(?: \d(?: \d)?)?"],
    "cc-by-nd": [r"creative commons attribution no ?deriv(?:ative)?s?(?: \d(?: \d)?)?", r"cc by nd(?: \d(?: \d)?)?"],
    "cc-by-nc-sa": [r"creative commons attribution non ?commercial share ?alike(?: \d(?: \d)?)?", r"cc by nc sa(?: \d(?: \d)?)?"],
    "cc-by-nc-nd": [r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: \d(?: \d)?)?", r"cc by nc nd(?: \d(?: \d)?)?"],
    "ofl-1.1": [r"sil open font licen[cs]e(?: version)?(?: 1 1)?"],
    "odbl-1": [r"open database licen[cs]e(?: version)?(?: 1(?: 0)?)?"],
}

#: Text around a name, priority, confidence.
FORMS = [
    (r"licen[cs]ed under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.95),
    (r"released under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.95),
    (r"(?:re)?distributed under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.95),
    (r"available under(?: the)?(?: terms of)?(?: the)? {name}", 3, 0.9),
    (r"subject to(?: the)?(?: terms of)?(?: the)? {name}", 2, 0.85),
    (r"(?:see|read)(?: the)? {name}(?: for(?: more)? details)?", 2, 0.7),
    (r"copy of(?: the)? {name}", 2, 0.75),
    (r"{name}", 1, 0.6),
]

#: Notices without the name of a licence: expression, label, priority, confidence.
NOTICES = [
    (r"all rights reserved", "all-rights-reserved", 1, 0.5),
    (r"spdx licen[cs]e identifier [^ ]+(?: \d[^ ]*)*", "spdx", 4, 1.0),
    (r"public domain", "public-domain", 1, 0.5),
    (r"permission is hereby granted free of charge to any person obtaining a copy", "mit", 4, 0.98),
    (r"redistribution and use in source and binary forms with or without modification are permitted", "bsd", 4, 0.98),
    (r"permission to use copy modify and or distribute this software for any purpose", "isc", 4, 0.98),
    (r"this program is free software you can redistribute it and or modify it", "gpl", 4, 0.98),
    (r"the software is provided as is without warranty of any kind", "no-warranty", 2, 0.5),
    (r"copyright(?: c)? (?:19|20)\d\d", "copyright", 1, 0.4),
]

#: A text without any of these has no detection; each rule's keyword contains one of them.
COARSE = [
    "licen", "cc by", "cc0", "gnu ", "creative commons", "all rights reserved", "public domain", "spdx",
    "permission ", "redistribution and use", "this program is free", "the software is provided", "copyright",
]

_TOP = max([p for _, p, _ in FORMS] + [p for *_, p, _ in NOTICES])


def literals(expression: str) -> list[str]:
    """Runs of literal characters that every match of the expression has."""
    plain = re.sub(r"\(\?:(?:[^()]|\([^()]*\))*\)\??|\[[^\]]*\][+*?]?|\\d[+*?]?", "\0", expression)
    plain = re.sub(r".\?", "\0", plain)
    return [part for part in re.split(r"[\0()|*+\\]", plain) if part]


def rules() -> list[tuple]:
    """number, label, base, priority, confidence, keyword, expression of each rule, in order."""
    found = [(re.escape(p).replace(r"\ ", " "), label, True, _TOP, 0.9) for p, label in BASE.items()]
    found += [(e, label, False, p, c) for e, label, p, c in NOTICES]
    for form, priority, confidence in FORMS:
        for label, names in NAMES.items():
            found += [(form.format(name=name), label, False, priority, confidence) for name in names]
    table = []
    for number, (expression, label, base, priority, confidence) in enumerate(found):
        fixed = literals(expression)
        if not any(key in f" {part} " for key in COARSE for part in fixed):
            raise ValueError(f"no coarse keyword for {expression}")
        table.append((number, label, base, priority, confidence, max(fixed, key=len), f"(?<= ){expression}(?= )"))
    return table


def word_text(text: Column) -> Column:
    """The words of a text, A-Z as a-z, each between two single spaces; one space if there are none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.regexp_replace(
        F.concat(F.lit(" "), lowered, F.lit(" ")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "
    )


def _spaces(text: str) -> str:
    return f"(octet_length({text}) - octet_length(replace({text}, ' ', '')))"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections of every row.

    detections: start, words, label, rule, priority of those that stay, in text
    order, words counted from 0. score is the highest confidence of a detection
    or base phrase, 0 if there is none. A null or empty text has no words. Rows
    are looked at one by one: repeated rows and null ids are kept. Columns other
    than doc_id and text are not looked at.
    """
    fields = ("rule", "label", "base", "priority", "confidence", "keyword", "expression")
    table = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, rule)]) for rule in rules()])
    # All matches of a rule with their first word and number of words: the text between
    # two matches and the matches themselves, added up.
    matches = f"""
        flatten(transform(
          filter(rules, r -> contains(words, r.keyword)),
          r -> aggregate(
            zip_with(
              split(words, r.expression, -1), regexp_extract_all(words, r.expression, 0),
              (gap, match) -> named_struct('gap', {_spaces('gap')}, 'match', {_spaces('match')})
            ),
            named_struct('at', cast(0 as bigint), 'found', cast(array() as array<struct<start: bigint, words: bigint>>)),
            (s, x) -> named_struct(
              'at', cast(s.at + x.gap + coalesce(x.match, 0) as bigint),
              'found', if(x.match is null, s.found, concat(s.found, array(named_struct(
                'start', cast(s.at + x.gap - 1 as bigint), 'words', cast(x.match + 1 as bigint)))))
            ),
            s -> transform(s.found, f -> named_struct(
              'start', f.start, 'back', -(f.start + f.words), 'down', -r.priority, 'rule', r.rule,
              'label', r.label, 'base', r.base, 'confidence', r.confidence))
          )
        ))"""
    # In order of start, longest first, highest priority first: one is contained if an
    # earlier one of no lower priority ends no earlier.
    levels = [f"e{p}" for p in range(1, _TOP + 1)]
    ends = ", ".join(f"'{e}', 0L" for e in levels)
    moved = ", ".join(
        f"'{e}', if(-d.down = {p}, greatest(s.{e}, -d.back), s.{e})" for p, e in enumerate(levels, start=1)
    )
    inside = " or ".join(f"(s.{e} >= -d.back and {p} >= -d.down)" for p, e in enumerate(levels, start=1))
    stay = f"""
        aggregate(
          array_sort(filter(found, d -> not d.base)),
          named_struct({ends}, 'kept', cast(array() as array<struct<start: bigint, words: bigint, label: string, rule: int, priority: int, confidence: double>>)),
          (s, d) -> named_struct({moved}, 'kept', if({inside}, s.kept, concat(s.kept, array(named_struct(
            'start', d.start, 'words', -d.back - d.start, 'label', d.label, 'rule', d.rule, 'priority', -d.down,
            'confidence', d.confidence))))),
          s -> s.kept
        )"""
    words = docs.select("doc_id", word_text(F.col("text")).alias("words"))
    coarse = F.lit(False)
    for key in COARSE:
        coarse = coarse | F.col("words").contains(key)
    kind = "array<struct<start: bigint, back: bigint, down: int, rule: int, label: string, base: boolean, confidence: double>>"
    empty = F.expr(f"cast(array() as {kind})")
    found = words.select(
        "doc_id", F.expr(f"cast({_spaces('words')} - 1 as bigint)").alias("n_words"), "words", coarse.alias("able"), table.alias("rules")
    ).select("doc_id", "n_words", F.when(F.col("able"), F.expr(matches)).otherwise(empty).alias("found"))
    base = F.filter("found", lambda d: d["base"])
    found = found.select("doc_id", "n_words", base.alias("base"), F.expr(stay).alias("detections"))
    starts = F.transform("base", lambda d: d["start"])
    labels = F.transform("base", lambda d: d["label"])
    own = F.transform("detections", lambda d: d["label"])
    sure = F.array_max(
        F.concat(F.transform("base", lambda d: d["confidence"]), F.transform("detections", lambda d: d["confidence"]))
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels, own))), ",").alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"),
        "detections",
    )
