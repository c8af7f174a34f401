"""License scan: ordered signature rules, gated by keywords, overlaps resolved.

Every rule is a regular expression over a text's words, with a label, a priority
and a keyword that each of its matches holds.  A text without any keyword is
only counted; for the others the rules whose keyword occurs are matched, all
places of each.  A detection inside another one of higher priority, or inside a
longer one of the same, is suppressed; of equal spans of one priority the first
rule's stands.  All of it is Spark expressions: matching happens within a row,
and places and suppression are windows over one row for each match, so a text
costs time in proportion to its matches.

Texts are matched as " w1  w2  ... ", every word between blanks of its own, so
that neighbouring matches share nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: ASCII characters that end a word; all others, and those beyond ASCII, belong to words once A-Z is lower-cased.
_SEP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The base phrases and their labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: License families: label, keyword, name in words, versions ("" : none).  A name's alternatives all hold the keyword.
FAMILIES = (
    ("apache", "apache", "apache(?: software)?", ("1 0", "1 1", "2 0", "2")),
    ("gpl", "gnu", "gnu(?: general public| gpl)", ("1 0", "1", "2 0", "2", "3 0", "3")),
    ("gpl", "gpl", "gpl", ("1 0", "1", "2 0", "2", "3 0", "3")),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", ("2 0", "2 1", "3 0", "3")),
    ("lgpl", "lgpl", "lgpl", ("2 0", "2 1", "3 0", "3")),
    ("agpl", "affero", "(?:gnu )?affero general public", ("1 0", "3 0", "3")),
    ("agpl", "agpl", "agpl", ("1 0", "3 0", "3")),
    ("gfdl", "documentation", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", "mozilla public", ("1 0", "1 1", "2 0", "2")),
    ("mpl", "mpl", "mpl", ("1 0", "1 1", "2 0", "2")),
    ("epl", "eclipse", "eclipse public", ("1 0", "2 0")),
    ("epl", "epl", "epl", ("1 0", "2 0")),
    ("edl", "eclipse", "eclipse distribution", ("1 0",)),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")),
    ("cddl", "development", "common development and distribution", ("1 0", "1 1")),
    ("cpl", "common", "common public", ("1 0",)),
    ("eupl", "eupl", "eupl", ("1 0", "1 1", "1 2")),
    ("eupl", "european", "european union public", ("1 0", "1 1", "1 2")),
    ("osl", "open", "open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic", "academic free", ("1 2", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")),
    ("bsl", "boost", "boost software", ("1 0",)),
    ("busl", "business", "business source", ("1 1",)),
    ("sspl", "sspl", "sspl", ("1 0", "1")),
    ("sspl", "server", "server side public", ("1 0", "1")),
    ("elastic", "elastic", "elastic", ("1 0", "2 0")),
    ("cecill", "cecill", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("ofl", "sil", "sil open font", ("1 0", "1 1")),
    ("odbl", "odbl", "odbl", ("1 0",)),
    ("odbl", "database", "open database", ("1 0",)),
    ("odc-by", "attribution", "open data commons attribution", ("1 0",)),
    ("pddl", "domain", "public domain dedication and license", ("1 0",)),
    ("ogl", "government", "open government", ("1 0", "2 0", "3 0")),
    ("python", "python", "python software foundation", ("2 0", "2")),
    ("php", "php", "php", ("3 0", "3 01")),
    ("ms-pl", "microsoft", "microsoft public", ("",)),
    ("ms-rl", "microsoft", "microsoft reciprocal", ("",)),
    ("qpl", "q", "q public", ("1 0",)),
    ("lppl", "latex", "latex project public", ("1 0", "1 2", "1 3")),
    ("zpl", "zope", "zope public", ("1 1", "2 0", "2 1")),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", ("",)),
    ("openrail", "openrail", "(?:bigscience |creativeml )?openrail(?: m)?", ("",)),
    ("upl", "universal", "universal permissive", ("1 0",)),
    ("mit", "mit", "mit(?: x11)?", ("",)),
    ("isc", "isc", "isc", ("",)),
    ("zlib", "zlib", "zlib(?: libpng)?", ("",)),
    ("unlicense", "unlicense", "unlicense", ("",)),
    ("wtfpl", "wtfpl", "wtfpl", ("",)),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd bsd)", ("",)),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ("",)),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", ("",)),
    ("bsd", "bsd", "bsd", ("",)),
)
#: Creative Commons elements in words, and the versions they come in.
CC = {"by": "by", "by sa": "by-sa", "by nd": "by-nd", "by nc": "by-nc", "by nc sa": "by-nc-sa", "by nc nd": "by-nc-nd"}
CC_LONG = {
    "attribution": "by",
    "attribution sharealike": "by-sa",
    "attribution share alike": "by-sa",
    "attribution noderivatives": "by-nd",
    "attribution noderivs": "by-nd",
    "attribution noncommercial": "by-nc",
    "attribution non commercial": "by-nc",
    "attribution noncommercial sharealike": "by-nc-sa",
    "attribution noncommercial share alike": "by-nc-sa",
    "attribution noncommercial noderivatives": "by-nc-nd",
    "attribution noncommercial noderivs": "by-nc-nd",
}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Sentences of the licenses' own texts and of the usual notices, written out in words: label, priority, keyword, expression.
SINGLE = (
    ("cc0", 80, "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 80, "creative", "creative commons zero(?: v?1 0)?(?: universal)?"),
    ("cc0", 72, "waives", "waives all of his or her rights to the work worldwide under copyright law"),
    ("cc0", 70, "deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("public-domain", 60, "domain", "(?:released|dedicated|placed|is|are) (?:in|into|to) the public domain"),
    ("public-domain", 58, "copyright", "(?:hereby )?(?:disclaims?|waives?) (?:all )?copyright (?:interest )?(?:in|to) this (?:software|work|source code)"),
    ("public-domain", 62, "blessing", "in place of a legal notice here is a blessing"),
    ("mit", 70, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 72, "sublicense", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 68, "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 55, "noninfringement", "warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-0", 74, "attribution", "mit no attribution(?: license| licence)?"),
    ("x11", 72, "consortium", "the name of the x consortium shall not be used in advertising"),
    ("isc", 70, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("isc", 72, "fee", "for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("hpnd", 69, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", 70, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 66, "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 66, "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 70, "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", 72, "endorse", "nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 72, "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("bsd-2-clause", 64, "representing", "those of the authors and should not be interpreted as representing official policies"),
    ("apache-2", 74, "apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2", 76, "apache", "licensed under the apache license version 2 0 the license"),
    ("apache-2", 64, "conditions", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-1.1", 74, "apache", "this product includes software developed by the apache software foundation"),
    ("gpl", 70, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", 60, "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", 58, "gnu", "you should have received a copy of the gnu general public license"),
    ("gpl-2", 78, "gnu", "gnu general public license version 2 june 1991"),
    ("gpl-3", 78, "gnu", "gnu general public license version 3 29 june 2007"),
    ("gpl", 56, "freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", 72, "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", 75, "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", 75, "redistribute", "you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("lgpl", 58, "lesser", "you should have received a copy of the gnu lesser general public license"),
    ("lgpl-2.1", 78, "lesser", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", 78, "lesser", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl", 75, "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", 58, "affero", "you should have received a copy of the gnu affero general public license"),
    ("agpl-3", 78, "affero", "gnu affero general public license version 3 19 november 2007"),
    ("gpl-classpath", 80, "exception", "as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("mpl-2", 76, "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", 76, "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1", 76, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", 76, "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cddl", 74, "development", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", 70, "implied", "this software is provided as is without any express or implied warranty in no event"),
    ("zlib", 72, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 70, "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("bsl-1", 72, "boost", "distributed under the boost software license version 1 0"),
    ("bsl-1", 70, "accompanying", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 72, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", 70, "compile", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 72, "want", "do what the fuck you want to public license"),
    ("wtfpl", 70, "want", "you just do what the fuck you want to"),
    ("beerware", 72, "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("ofl-1.1", 74, "font", "this font software is licensed under the sil open font license version 1 1"),
    ("artistic", 66, "package", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", 74, "package", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("python-2", 74, "python", "this license agreement is between the python software foundation psf and the individual or organization"),
    ("openssl", 74, "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", 70, "curl", "curl license"),
    ("ftl", 70, "freetype", "freetype (?:project )?license"),
    ("ijg", 70, "jpeg", "this software is based in part on the work of the independent jpeg group"),
    ("libpng", 70, "libpng", "libpng license(?: version 2)?"),
    ("vim", 70, "vim", "vim license"),
    ("ruby", 70, "ruby", "ruby license"),
    ("json", 74, "evil", "the software shall be used for good not evil"),
    ("icu", 70, "icu", "icu license(?: icu 1 8 1 and later)?"),
    ("unicode", 72, "unicode", "unicode(?: inc)? license agreement(?: data files and software)?"),
    ("w3c", 72, "w3c", "w3c software notice and license"),
    ("opl", 70, "publication", "open publication license(?: v?1 0)?"),
    ("fal", 70, "art", "free art license(?: 1 3)?"),
    ("etalab", 70, "ouverte", "(?:licence|license) ouverte(?: open licence)?(?: etalab)?"),
    ("llama", 72, "llama", "llama (?:2|3|3 1) community license(?: agreement)?"),
    ("commons-clause", 74, "commons", "commons clause license condition(?: v1 0)?"),
    ("polyform", 72, "polyform", "polyform (?:noncommercial|small business|strict|shield) license(?: 1 0 0)?"),
    ("no-derivatives", 50, "derivative", "no derivative works (?:are )?(?:allowed|permitted)"),
    ("noncommercial", 50, "commercial", "for non commercial use only"),
    ("noncommercial", 50, "noncommercial", "for noncommercial use only"),
    ("noncommercial", 48, "commercial", "commercial use is (?:strictly )?(?:prohibited|not permitted|not allowed)"),
    ("research-only", 52, "research", "for research(?: and (?:academic|educational))? (?:use|purposes) only"),
    ("research-only", 52, "academic", "for academic(?: and (?:research|educational))? (?:use|purposes) only"),
    ("proprietary", 50, "rights", "all rights reserved"),
    ("proprietary", 55, "proprietary", "proprietary and confidential"),
    ("proprietary", 54, "unauthorized", "unauthorized (?:copying|reproduction|use|distribution)(?: or (?:copying|reproduction|use|distribution))? of this (?:file|document|material|software)"),
    ("proprietary", 53, "trade", "contains (?:confidential )?trade secrets of"),
    ("proprietary", 53, "user", "end user license agreement"),
)
_LEAD = "(?:licensed|distributed|released|available|provided|published|covered|made available) under (?:the )?(?:terms of (?:the )?)?(?:conditions of (?:the )?)?"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    regex: str


def _label(base: str, version: str) -> str:
    number = version.replace(" ", ".").removesuffix(".0")
    return f"{base}-{number}" if number else base


def rules() -> list[Rule]:
    """All rules in their order: the most specific forms of a license have the highest priority."""
    out: list[Rule] = []
    for base, keyword, name, versions in FAMILIES:
        for version in versions:
            label = _label(base, version)
            v = f" (?:version |v )?{version}" if version else ""
            joined = f" v{version}" if version else ""
            kind = "(?: license| licence)?"
            later = " or (?:any |at your option any )?later(?: version)?"
            if version:
                out.append(Rule(label, 80, keyword, f"{name}{kind}{v}"))
                out.append(Rule(label, 78, keyword, f"{name}{kind}{joined}"))
                out.append(Rule(f"{label}-or-later", 85, keyword, f"{name}{kind}{v}{later}"))
                out.append(Rule(f"{label}-or-later", 88, keyword, f"{_LEAD}{name}{kind}{v}{later}"))
                out.append(Rule(f"{label}-only", 84, keyword, f"{name}{kind}{v} only"))
            out.append(Rule(label, 90, keyword, f"spdx license identifier {name}{' ' + version if version else ''}"))
            out.append(Rule(label, 82 if version else 60, keyword, f"{_LEAD}{name}{kind}{v}"))
        if "" in versions:
            out.append(Rule(base, 50, keyword, f"{name} (?:license|licence)"))
        else:
            out.append(Rule(base, 40, keyword, f"{name} (?:license|licence)"))
            out.append(Rule(base, 45, keyword, f"{_LEAD}{name}{kind}"))
    for words, code in CC.items():
        out.append(Rule(f"cc-{code}", 62 + len(words), "cc", f"cc {words}"))
        for version in CC_VERSIONS:
            out.append(Rule(f"cc-{code}", 80 + len(words), "cc", f"cc {words} {version}(?: international| unported| generic)?"))
    for words, code in CC_LONG.items():
        out.append(Rule(f"cc-{code}", 40 + len(words) // 2, "creative", f"creative commons {words}(?: international)?(?: license| licence)?"))
        for version in CC_VERSIONS:
            out.append(Rule(f"cc-{code}", 70 + len(words) // 2, "creative", f"creative commons {words} {version}(?: international| unported| generic)?(?: public)?(?: license| licence)?"))
    out += [Rule(*x) for x in SINGLE]
    return list(dict.fromkeys(out))


def _spaced(regex: str) -> str:
    """The expression over words between blanks of their own."""
    return " (?:" + regex.replace(" ", "  ") + ") "


def _gate() -> str:
    words = sorted({r.keyword for r in rules()} | {"license", "apache", "cc"})
    return f"(?i)(?:^|[{_SEP}])(?:{'|'.join(words)})(?=[{_SEP}]|$)"


def _blanks(x: str) -> str:
    return f"length({x}) - length(replace({x}, ' ', ''))"


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _base_regex() -> str:
    return _spaced("|".join(BASE))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scan whole texts for licenses.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and detections (label, priority, start word, number of words), one row
    per input row.  score is the highest priority among the detections that
    stand, over 100, and 0 without any.  A null text counts as empty; an empty
    table gives an empty result; repeated rows are scanned alike.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
    # splitting is several times as fast here as counting or replacing matches
    split = docs.select("doc_id", "t", F.split("t", f"[{_SEP}]+").alias("w"))
    words = F.size("w") - (F.col("w")[0] == "").cast("int") - ((F.size("w") > 1) & (F.element_at("w", -1) == "")).cast("int")
    counted = split.select("doc_id", words.cast("long").alias("n_words"), F.when(F.col("t").rlike(_gate()), F.array_join(F.filter("w", lambda x: x != ""), "  ")).alias("t"))
    spaced = counted.select("doc_id", "n_words", F.concat(F.lit(" "), F.translate("t", UPPER, LOWER), F.lit(" ")).alias("t"))

    # the rules lie under their keywords, so that a text is searched once for each keyword
    under: dict[str, list[str]] = {}
    for k, r in enumerate(rules()):
        under.setdefault(r.keyword, []).append(f"named_struct('rule', {k}, 'label', {_quoted(r.label)}, 'priority', {r.priority}, 'regex', {_quoted(_spaced(r.regex))})")
    table = ", ".join(f"named_struct('keyword', {_quoted(f' {k} ')}, 'rules', array({', '.join(v)}))" for k, v in under.items())
    matched = "filter(transform(flatten(transform(filter(array(" + table + "), g -> contains(t, g.keyword)), g -> g.rules)), r -> named_struct('r', r, 'm', regexp_extract_all(t, r.regex, 0))), h -> size(h.m) > 0)"
    gaps = f"transform({matched}, h -> named_struct('r', h.r, 'm', h.m, 'p', split(t, h.r.regex, -1)))"  # what lies before each match
    widths = f"named_struct('gap', {_blanks('h.p[i]')}, 'words', {_blanks('x')})"
    hits = f"transform({gaps}, h -> named_struct('rule', h.r.rule, 'label', h.r.label, 'priority', h.r.priority, 'places', transform(h.m, (x, i) -> {widths})))"
    base = _quoted(_base_regex())
    names = "map(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in BASE.items()) + ")"
    found = spaced.select(
        "doc_id",
        "n_words",
        F.expr(f"case when t is not null then {hits} end").alias("hits"),
        F.expr(f"case when t is not null then regexp_extract_all(t, {base}, 0) end").alias("b"),
        F.expr(f"case when t is not null then split(t, {base}, -1) end").alias("parts"),
    )
    some = F.coalesce(F.size("b"), F.lit(0)) > 0
    rows = found.select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        "n_words",
        F.when(some, F.size("b")).otherwise(0).cast("long").alias("n_base"),
        F.when(some, F.expr(f"({_blanks('parts[0]')}) / 2").cast("long")).alias("first_word"),
        F.when(some, F.col("n_words") - F.expr(f"({_blanks('element_at(parts, -1)')} + {_blanks('element_at(b, -1)')}) / 2").cast("long")).alias("last_word"),
        F.array_distinct(F.expr(f"coalesce(transform(b, x -> element_at({names}, replace(trim(x), '  ', ' '))), array())")).alias("base"),
        "hits",
    )
    # one row for each match from here on: places are running sums, and a match is held against those that start shortly before it
    own = ["uid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    rows = rows.select(*own, F.explode_outer("hits").alias("h"))
    rows = rows.select(*own, F.col("h.rule").alias("rule"), F.col("h.label").alias("label"), F.col("h.priority").alias("priority"), F.posexplode_outer("h.places").alias("pos", "x")).repartition("uid")
    so_far = Window.partitionBy("uid", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blanks = F.sum(F.col("x.gap") + F.col("x.words")).over(so_far)
    placed = rows.select(*own, "rule", "label", "priority", ((blanks - F.col("x.words")) / 2).cast("long").alias("start"), (F.col("x.words") / 2).cast("long").alias("words"))
    ends = F.col("start") + F.col("words")
    near = Window.partitionBy("uid").orderBy("start").rangeBetween(-longest(), 0)
    around = F.collect_list(F.struct("rule", "priority", "start", "words")).over(near)
    inside = "y.start <= start and y.start + y.words >= start + words and (y.priority > priority or (y.priority = priority and (y.words > words or (y.words = words and y.rule < rule))))"
    judged = placed.withColumn("around", F.when(ends.isNotNull(), around)).withColumn("stands", F.expr(f"start is not null and not exists(around, y -> {inside})"))
    detection = F.struct("start", "words", "priority", "label")
    texts = judged.groupBy("uid").agg(*(F.first(c).alias(c) for c in own[1:]), F.array_sort(F.collect_list(F.when(F.col("stands"), detection))).alias("detections"))
    return texts.select(
        *own[1:6],
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.expr("transform(detections, x -> x.label)")))), ",").alias("labels"),
        F.coalesce(F.expr("array_max(transform(detections, x -> x.priority)) / 100.0D"), F.lit(0.0)).alias("score"),
        "detections",
    )


def longest() -> int:
    """A bound on the words of any match: no rule repeats anything, so it has a blank in its expression for each."""
    return max(r.regex.count(" ") for r in rules()) + 1


def sql() -> str:
    """DuckDB SQL for the scan of documents, without detections: every rule on every text, no gates."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {q(r.label)}, {r.priority}, {q(_spaced(r.regex))})" for k, r in enumerate(rules()))
    phrases = " ".join(f"when {q(k)} then {q(v)}" for k, v in BASE.items())
    base = q(_base_regex())
    return f"""
    with d as (
      select row_number() over () as row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
    n as (select row_id, doc_id, len(words)::bigint as n_words, ' ' || array_to_string(words, '  ') || ' ' as t from d),
    rules(rule, label, priority, re) as (values {values}),
    hits as (select row_id, rule, label, priority, regexp_extract_all(t, re) as m, string_split_regex(t, re) as p from n cross join rules where regexp_matches(t, re)),
    placed as (select row_id, rule, label, priority, m, p, unnest(range(1, len(m) + 1)) as i from hits),
    spans as (
      select row_id, rule, label, priority, {_blanks("(array_to_string(p[1:i], '') || array_to_string(m[1:i - 1], ''))")} as s, {_blanks('m[i]')} as w from placed),
    stand as (
      select * from spans x where not exists (
        select 1 from spans y where y.row_id = x.row_id and y.s <= x.s and y.s + y.w >= x.s + x.w
          and (y.priority > x.priority or (y.priority = x.priority and (y.w > x.w or (y.w = x.w and y.rule < x.rule)))))),
    own as (select row_id, list(distinct label) as labels, max(priority) / 100.0::double as score from stand group by row_id),
    b as (select row_id, regexp_extract_all(t, {base}) as m, string_split_regex(t, {base}) as p from n),
    bl as (select row_id, list_distinct(list_transform(m, lambda x: case replace(trim(x), '  ', ' ') {phrases} end)) as labels from b)
    select n.doc_id, n.n_words, len(b.m)::bigint as n_base,
      case when len(b.m) > 0 then (({_blanks('b.p[1]')}) // 2)::bigint end as first_word,
      case when len(b.m) > 0 then (n.n_words - ({_blanks('b.p[-1]')} + {_blanks('b.m[-1]')}) // 2)::bigint end as last_word,
      array_to_string(list_sort(bl.labels), ',') as base_labels,
      array_to_string(list_sort(list_distinct(list_concat(bl.labels, coalesce(own.labels, [])))), ',') as labels,
      coalesce(own.score, 0.0)::double as score
    from n join b using (row_id) join bl using (row_id) left join own using (row_id)"""
