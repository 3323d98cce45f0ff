"""License scan by ordered signature rules (operator 7), in DataFrame functions alone.

A text becomes its words. Texts without any keyword stem as a substring are done at that point. In the
others each keyword is an anchor, and the word next to it is a second gate: only the rules that allow both
look at the words around it, in which the anchor is marked, so every rule finds at most one interval of words
per anchor and all intervals are found. An interval goes when another one contains it and has a higher priority,
or the same priority and more words (or an earlier rule for equal intervals). Intervals reach ``REACH`` words from
their anchor, so each is compared with those of the anchors near it, and the work grows with the text.

Rules are regular expressions over words: phrases from the bodies and headers of licenses, written by hand,
and the ways to name a license, made from names and versions. All work stays inside a row: nothing is shuffled,
and rows may repeat.

Defined cases: a null text is empty and has no words and no labels. Further columns are ignored.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import query, table, text_or_empty

# Fixed values of the word and phrase contract
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, name as words, versions)
NAMES = [
    ("apache", r"apache(?: software)?(?: foundation)?", ("1.0", "1.1", "2.0")),
    ("gpl", r"(?:gnu )?(?:general public|gpl)", ("1", "2", "3")),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public|lgpl)", ("2", "2.1", "3")),
    ("agpl", r"(?:gnu )?(?:affero general public|agpl)", ("1", "3")),
    ("gfdl", r"(?:gnu )?(?:free documentation|gfdl|fdl)", ("1.1", "1.2", "1.3")),
    ("mpl", r"(?:mozilla public|mpl)", ("1.0", "1.1", "2.0")),
    ("epl", r"(?:eclipse public|epl)", ("1.0", "2.0")),
    ("cddl", r"(?:common development and distribution|cddl)", ("1.0", "1.1")),
    ("eupl", r"(?:european union public|eupl)", ("1.0", "1.1", "1.2")),
    ("artistic", r"artistic", ("1.0", "2.0")),
    ("osl", r"(?:open software|osl)", ("1.0", "2.0", "2.1", "3.0")),
    ("afl", r"(?:academic free|afl)", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("bsl", r"(?:boost software|bsl)", ("1.0",)),
    ("ofl", r"(?:sil )?(?:open font|ofl)", ("1.0", "1.1")),
    ("lppl", r"(?:latex project public|lppl)", ("1.0", "1.1", "1.2", "1.3")),
    ("zpl", r"(?:zope public|zpl)", ("1.1", "2.0", "2.1")),
    ("php", r"php", ("3.0", "3.01")),
    ("python", r"python(?: software foundation)?", ("2.0",)),
    ("mit", r"(?:mit|expat)(?: x11)?", ()),
    ("isc", r"(?:isc|internet systems consortium)", ()),
    ("zlib", r"zlib(?: libpng)?", ()),
    ("unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", r"(?:do what the fuck you want to public|wtfpl)", ()),
    ("ms-pl", r"(?:microsoft public|ms pl)", ()),
    ("ms-rl", r"(?:microsoft reciprocal|ms rl)", ()),
    ("postgresql", r"postgresql", ()),
    ("openssl", r"openssl", ()),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("odbl", r"(?:open database|odbl)", ("1.0",)),
    ("cc0", r"(?:creative commons )?(?:cc0|cc zero)", ("1.0",)),
    ("bsd", r"bsd", ()),
]
CC_PARTS = {"by": "(?:by|attribution)", "nc": "(?:nc|non ?commercial)", "sa": "(?:sa|share ?alike)", "nd": "(?:nd|noderivs|noderivatives|no derivs|no derivatives)"}
CC_KINDS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
# Phrases by hand: label, priority, words with the anchor marked; a plain word stands next to the anchor
PHRASES = """
copyright 1 #copyright(?: c)? [0-9]{4}
copyright 1 all #copyright reserved
copyright 1 all #copyrights reserved
copyright 1 #copyright holders? and contributors
copyright 1 #copyrighted (?:material|work|by)
copyright 1 the above #copyright notice
copyright 1 retain the above #copyright notice
copyright 1 reproduce the above #copyright notice
proprietary 2 #proprietary and confidential
proprietary 2 confidential and #proprietary
proprietary 2 #proprietary license
proprietary 2 unpublished #proprietary source code
proprietary 2 #proprietary software
proprietary 2 trade secrets and #proprietary information
license-mention 1 open source #licenses
license-mention 1 third party #licenses
license-mention 1 see the #license file
license-mention 1 see #license for (?:details|more information)
license-mention 1 see the file #license
license-mention 1 end user #license agreement
license-mention 1 software #license agreement
license-mention 1 free software #license
license-mention 1 open source #license
license-mention 1 dual #licensed
no-warranty 1 without #warranty of any kind
no-warranty 1 without any #warranty
no-warranty 1 without even the implied #warranty of
no-warranty 1 without any express or implied #warranty
no-warranty 1 without #warranties or conditions of any kind
no-warranty 1 any express or implied #warranties
no-warranty 1 there is no #warranty
no-warranty 1 comes with absolutely no #warranty
no-warranty 1 the implied #warranties of
no-warranty 1 disclaims all #warranties
no-warranty 1 #merchantability and fitness for a particular purpose
no-warranty 1 #merchantability or fitness for a particular purpose
no-warranty 1 #merchantability fitness for a particular purpose and noninfringement
mit 3 #permission is hereby granted free of charge to any person obtaining a copy
mit 3 publish distribute #sublicense and or sell copies
mit 2 the above copyright notice and this #permission notice shall be included
isc 3 #permission to use copy modify and or distribute this software for any purpose
isc 3 #permission to use copy modify and distribute this software for any purpose
hpnd 3 #permission to use copy modify and distribute this software and its documentation for any purpose
hpnd 2 that both that copyright notice and this #permission notice appear in supporting documentation
x11 3 advertising or otherwise to promote the sale use or other dealings in this software without prior written #authorization from
curl 3 provided that the above copyright notice and this #permission notice appear in all copies
bsd 3 #redistribution and use in source and binary forms
bsd 3 #redistributions of source code must retain the above copyright notice
bsd 3 #redistributions in binary form must reproduce the above copyright notice
bsd-3-clause 3 endorse or promote products derived from this software without specific prior written #permission
bsd-3-clause 3 products derived from this software without specific prior written #permission
bsd-4-clause 3 all #advertising materials mentioning features or use of this software
bsd 2 new bsd #license
bsd-2-clause 3 simplified bsd #license
bsd-2-clause 3 freebsd #license
bsd-3-clause 3 revised bsd #license
bsd-3-clause 3 modified bsd #license
bsd-3-clause 3 three clause bsd #license
bsd-2-clause 3 two clause bsd #license
bsd-4-clause 3 original bsd #license
apache-2.0 3 you may not use this file except in compliance with the #license
apache-2.0 3 unless required by applicable law or agreed to in writing software distributed under the #license
apache-2.0 3 limitations under the #license
apache-2.0 3 specific language governing permissions and limitations under the #license
apache-2.0 3 perpetual worldwide non exclusive no charge royalty free irrevocable #copyright license
apache-2.0 3 no charge royalty free irrevocable except as stated in this section #patent license
apache-2.0 3 you may obtain a copy of the #license at
gpl 3 you can #redistribute it and or modify it under the terms of the gnu general public
gpl 3 under the terms of the gnu general public #license
gpl 3 the terms of the gnu gpl #license
gpl 3 you should have received a copy of the gnu general public #license
gpl 3 see the gnu general public #license for more details
gpl-2 4 general public #license as published by the free software foundation either version 2
gpl-3 4 general public #license as published by the free software foundation either version 3
gpl-2-only 4 general public #license version 2 only
gpl-2-only 4 general public #license version 2 as published by
gpl-2 3 gnu general public #license version 2 june 1991
gpl-3 3 gnu general public #license version 3 29 june 2007
gpl 2 gnu #copyleft
gpl 2 strong #copyleft
lgpl 3 you can #redistribute it and or modify it under the terms of the gnu lesser general public
lgpl 3 you can #redistribute it and or modify it under the terms of the gnu library general public
lgpl 4 under the terms of the gnu lesser general public #license
lgpl 4 under the terms of the gnu library general public #license
lgpl 4 received a copy of the gnu lesser general public #license
lgpl-2.1 4 lesser general public #license as published by the free software foundation either version 2 1
lgpl-3 4 lesser general public #license as published by the free software foundation either version 3
agpl 3 you can #redistribute it and or modify it under the terms of the gnu affero general public
agpl 4 under the terms of the gnu affero general public #license
agpl-3 4 affero general public #license as published by the free software foundation either version 3
gfdl 3 #permission is granted to copy distribute and or modify this document under the terms of the gnu free
gfdl 3 under the terms of the gnu free documentation #license
mpl-2.0 4 subject to the terms of the mozilla public #license v 2 0
mpl-1.1 4 subject to the mozilla public #license version 1 1
mpl 3 this source code form is subject to the terms of the mozilla public #license
epl 3 made available under the terms of the eclipse public #license
epl-2.0 4 terms of the eclipse public #license 2 0
epl-1.0 4 terms of the eclipse public #license v1 0
cddl 3 the contents of this file are subject to the terms of the common development and distribution #license
cpl 3 common public #license
ipl 3 ibm public #license
spl 3 sun public #license
npl 3 netscape public #license
apsl 3 apple public source #license
qpl 3 q public #license
rpl 3 reciprocal public #license
sleepycat 3 sleepycat #license
sspl 3 server side public #license
elastic 3 elastic #license
busl 3 business source #license
commons-clause 3 commons clause #license condition
polyform 3 polyform noncommercial #license
polyform 3 polyform shield #license
confluent 3 confluent community #license
redis 3 redis source available #license
upl 3 universal permissive #license
0bsd 3 zero clause bsd #license
blueoak 3 blue oak model #license
beerware 3 beer ware #license
beerware 3 beerware #license
jpeg 3 independent jpeg group #license
libpng 3 libpng #license
freetype 3 freetype #license
freetype 3 freetype project #license
info-zip 3 info zip #license
ruby 3 ruby #license
perl 3 perl artistic #license
vim 3 vim #license
tcl 3 tcl tk #license
w3c 3 w3c software #license
w3c 3 w3c software notice and #license
unicode 3 unicode #license agreement
icu 3 icu #license
json 3 json #license
intel 3 intel open source #license
nasa 3 nasa open source agreement #license
cecill 3 cecill #license
cecill 3 cecill free software #license
mulan 3 mulan permissive software #license
mulan 3 mulan psl #license
ecl 3 educational community #license
naumen 3 naumen public #license
nokia 3 nokia open source #license
sissl 3 sun industry standards source #license
watcom 3 sybase open watcom public #license
xfree86 3 xfree86 #license
zimbra 3 zimbra public #license
openrail 3 openrail #license
openrail 3 open rail m #license
llama 3 llama community #license
llama 3 llama 2 community #license
llama 3 llama 3 community #license
zlib 3 #permission is granted to anyone to use this software for any purpose
bsl 3 #permission is hereby granted free of charge to any person or organization
unlicense 3 this is free and #unencumbered software released into the public domain
unlicense 3 #unencumbered software released into the public domain
public-domain 2 placed in the public domain without #copyright
public-domain 2 the author disclaims #copyright to this source code
public-domain 2 no #copyright is claimed
cc0 3 dedicated all #copyright and related
cc0 3 waived all #copyright and related
cc0 3 public domain dedication #license
cc 2 creative commons #license
cc 2 some rights reserved creative commons #licence
cc-by 3 creative commons attribution #license
cc-by-4.0 4 creative commons attribution 4 0 international #license
cc-by-3.0 4 creative commons attribution 3 0 unported #license
cc-by-sa-4.0 4 creative commons attribution sharealike 4 0 international #license
cc-by-sa-3.0 4 creative commons attribution sharealike 3 0 unported #license
cc-by-nc-4.0 4 creative commons attribution noncommercial 4 0 international #license
cc-by-nd-4.0 4 creative commons attribution noderivatives 4 0 international #license
cc-by-nc-sa-4.0 4 creative commons attribution noncommercial sharealike 4 0 international #license
cc-by-nc-nd-4.0 4 creative commons attribution noncommercial noderivatives 4 0 international #license
ofl 3 this font software is #licensed under the sil open font
ofl 3 the font software may not be #sublicensed
odbl 3 open data commons open database #license
odc-by 3 open data commons attribution #license
pddl 3 open data commons public domain dedication and #licence
ogl 3 open government #licence
ogl-3 4 open government #licence v3 0
etalab 3 etalab open #licence
dl-de 3 data #licence germany
cdla 3 community data #license agreement
non-commercial 2 for #noncommercial use only
non-commercial 2 #noncommercial purposes only
evaluation 2 evaluation #license
commercial 2 commercial #license
commercial 2 commercially #licensed
patent 2 grant of #patent license
patent 2 #patent rights granted
restricted 2 may not be #redistributed
restricted 2 no part of this work may be reproduced without prior written #permission
restricted 2 reproduced by #permission of
restricted 2 used with #permission of
restricted 2 reprinted with #permission
restricted 2 unauthorized #copying of this file
"""
# Every keyword holds one of these.
STEMS = ("licen", "copy(?:right|left|ing)", "spdx", "proprietary", "redistribut", "warrant", "permission", "merchantability",
         "unencumbered", "noncommercial", "patent", "advertising", "authorization")
CONFIDENCE = {1: 0.4, 2: 0.7, 3: 0.9, 4: 1.0}
REACH = 20  # words on each side of an anchor; no rule is longer


def _version_words(version: str) -> str:
    major, _, minor = version.partition(".")
    tail = "" if not minor else f"(?: {minor})?" if minor == "0" else f" {minor}"
    return rf"(?: (?:version|v))? v?{major}{tail}"


def _named() -> list[tuple[str, str, str]]:
    """(label, name, version as words or nothing)."""
    out = [(label, name, "") for label, name, _ in NAMES]
    out += [(f"{label}-{v}", name, _version_words(v)) for label, name, vs in NAMES for v in vs]
    out += [(f"bsd-{n}-clause", rf"bsd {n} clause|{n} clause bsd", "") for n in (2, 3, 4)]
    for kind, version in product(CC_KINDS, ("", *CC_VERSIONS)):
        parts = " ".join(CC_PARTS[p] for p in kind.split("-"))
        words = _version_words(version) if version else ""
        out.append((f"cc-{kind}" + f"-{version}" * bool(version), rf"(?:cc|creative commons) {parts}", words))
    return out


def _words_of(name: str) -> set[str]:
    """Every word that can stand in a name, and perhaps some more."""
    name = name.replace("(?:", " ( ")
    return {w for n in (name, name.replace(" ?", "")) for w in re.findall("[a-z0-9]+", n)}


def rules() -> list[tuple[int, list[str], str, int, str]]:
    """(number, gates, label, priority, pattern with the anchor after a mark), in order.

    A gate is the marked keyword with the word before or after it.
    """
    found = []
    for label, name, version in _named():
        priority = 3 if version else 2
        article, words, name = r"(?:the |a |an )?", sorted(_words_of(name)), rf"(?:{name})"
        before = lambda keyword: [f"{w} #{keyword}" for w in words]  # noqa: B023, E731
        found.append((before("license"), label, rf"{name} #license{version}", priority))
        found.append((before("license"), label, rf"(?:under|by) {article}{name} #license{version}", priority))
        found.append((["#licensed under"], label, rf"#licensed under {article}{name}(?: licen[sc]e)?{version}", priority))
        found.append((before("licence"), label, rf"{name} #licence{version}", priority))
        spdx = label.replace("-", " ").replace(".", " ")
        found.append((["#spdx license"], label, rf"#spdx license identifier {spdx}(?: only| or later)?", 4))
    for line in PHRASES.strip().splitlines():
        label, priority, pattern = line.split(" ", 2)
        gate = re.search(r"(?<![^ ])[a-z0-9]+ #[a-z]+", pattern) or re.search(r"#[a-z]+ [a-z0-9]+(?![^ ])", pattern)
        # the years of a copyright line can't be a gate: the rule is tried at every such anchor
        found.append(([gate[0] if gate else "#" + re.search("#([a-z]+)", pattern)[1]], label, pattern, int(priority)))
    return [(i, gates, label, p, rf"(?<![^ ]){pattern}(?![^ ])") for i, (gates, label, pattern, p) in enumerate(found)]


def keywords() -> list[str]:
    return sorted({re.search("#([a-z]+)", g)[1] for _, gates, _, _, _ in rules() for g in gates})


def _rules_at(before: Column, word: Column, after: Column) -> Column:
    """The numbers of the rules that the anchor and its neighbours let through."""
    by_gate: dict[str, list[int]] = {}
    for number, gates, _, _, _ in rules():
        for gate in gates:
            by_gate.setdefault(gate, []).append(number)
    gated = F.create_map(*[x for g, r in by_gate.items() for x in (F.lit(g), F.lit(np.array(r, np.int32)))])
    word = F.concat(F.lit("#"), word)
    asked = F.filter(F.array(word, F.concat(before, F.lit(" "), word), F.concat(word, F.lit(" "), after)), lambda g: g.isNotNull())
    return F.flatten(F.filter(F.transform(asked, lambda g: F.try_element_at(gated, g)), lambda r: r.isNotNull()))


def _base_places(words: Column, anchors: Column) -> Column:
    """Start and label of each place of a base phrase; all of them end in the same word."""

    def at(anchor: Column, phrase: str) -> Column:
        parts = phrase.split(" ")
        same = [F.get(words, anchor - (len(parts) - 1 - i)) == p for i, p in enumerate(parts)]
        whole = F.coalesce(same[0], F.lit(False))
        for s in same[1:]:
            whole = whole & F.coalesce(s, F.lit(False))
        place = F.struct((anchor - (len(parts) - 1)).alias("start"), F.lit(BASE[phrase]).alias("label"))
        return F.when(whole & (anchor >= len(parts) - 1), place)

    found = F.flatten(F.transform(anchors, lambda a: F.array(*[at(a, phrase) for phrase in BASE])))
    return F.filter(found, lambda x: x.isNotNull())


def _matches(words: Column, anchors: Column) -> Column:
    """The strongest intervals of each anchor: number, label, priority, start, end (exclusive)."""

    column = lambda i, kind: F.lit(np.array([r[i] for r in rules()], kind))
    labels, priorities, patterns = column(2, np.str_), column(3, np.int32), column(4, np.str_)

    def around(a: Column) -> Column:
        first = F.greatest(a - REACH, F.lit(0))
        before, after = F.slice(words, first + 1, a - first), F.slice(words, a + 2, REACH)
        marked = F.array(F.concat(F.lit("#"), F.get(words, a)))
        return F.array_join(F.concat(before, marked, after), " ")

    def intervals(a: Column, window: Column) -> Column:
        def found(number: Column) -> Column:
            text = F.regexp_substr(window, F.element_at(patterns, number + 1))
            start = a - (F.size(F.split(F.substring_index(text, "#", 1), " ")) - 1)
            return F.when(
                text.isNotNull(),
                F.struct(
                    number.alias("number"), F.element_at(labels, number + 1).alias("label"), F.element_at(priorities, number + 1).alias("priority"),
                    start.alias("start"), (start + F.size(F.split(text, " "))).alias("end"),
                ),
            )

        hits = F.transform(_rules_at(F.when(a > 0, F.get(words, a - 1)), F.get(words, a), F.get(words, a + 1)), found)
        return F.filter(F.coalesce(hits, F.array()), lambda x: x.isNotNull())

    return F.transform(
        anchors, lambda a: F.flatten(F.transform(F.array(around(a)), lambda w: _strongest(intervals(a, w))))
    )


def _beats(a: Column, b: Column) -> Column:
    """Whether b contains a and goes before it."""
    length = lambda x: x["end"] - x["start"]
    earlier = (length(b) > length(a)) | ((length(b) == length(a)) & (b["number"] < a["number"]))
    return (b["start"] <= a["start"]) & (b["end"] >= a["end"]) & (
        (b["priority"] > a["priority"]) | ((b["priority"] == a["priority"]) & earlier)
    )


def _strongest(intervals: Column) -> Column:
    """Containment suppression; the array is bound once, since it is used for each element."""
    return F.flatten(F.transform(
        F.array(intervals), lambda all_: F.filter(all_, lambda a: ~F.exists(all_, lambda b: _beats(a, b)))
    ))


def _strongest_of_all(per_anchor: Column) -> Column:
    """Containment suppression between the anchors of a text.

    What contains an interval has its anchor within twice ``REACH`` words, so no more anchors than that away.
    """
    near = 2 * REACH

    def kept(all_: Column) -> Column:
        def of_anchor(own: Column, i: Column) -> Column:
            first = F.greatest(i - near, F.lit(0))
            others = F.flatten(F.slice(all_, first + 1, i - first + near + 1))
            return F.flatten(F.transform(F.array(others), lambda o: F.filter(own, lambda a: ~F.exists(o, lambda b: _beats(a, b)))))

        return F.flatten(F.transform(all_, of_anchor))

    return F.flatten(F.transform(F.array(per_anchor), kept))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base places, and ``found``: the intervals that remain, with their labels."""
    lower = F.translate(text_or_empty(), UPPER, LOWER)
    words = docs.select("doc_id", lower.alias("lower")).select(
        "doc_id", F.col("lower").rlike("|".join(STEMS)).alias("gate"), F.regexp_extract_all("lower", F.lit(WORD), F.lit(0)).alias("words")
    )
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(*keywords()))
    none = F.array().cast("array<int>")
    anchored = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), "words",
        F.when(F.col("gate") & (F.size("words") > 0), places).otherwise(none).alias("anchors"),
    )
    return anchored.select(
        "doc_id", "n_words",
        F.when(F.size("anchors") > 0, _base_places(F.col("words"), F.col("anchors"))).alias("base"),
        F.when(F.size("anchors") > 0, _strongest_of_all(_matches(F.col("words"), F.col("anchors")))).alias("found"),
    )


@query("op7_license_signatures")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    starts = F.transform("base", lambda x: x["start"])
    base = F.coalesce(F.transform("base", lambda x: x["label"]), F.array().cast("array<string>"))
    own = F.coalesce(F.transform("found", lambda x: x["label"]), F.array().cast("array<string>"))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    sure = F.element_at(F.create_map(*[F.lit(x) for p in CONFIDENCE.items() for x in p]), F.array_max(F.transform("found", lambda x: x["priority"])))
    score = F.greatest(F.coalesce(sure, F.lit(0.0)), F.when(F.size(base) > 0, F.lit(CONFIDENCE[2])).otherwise(F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", F.coalesce(F.size(base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"), score.alias("score"),
    )
