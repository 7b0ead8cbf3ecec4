"""License scans by sentence rules, with DataFrame functions only.

A text is cut into sentences, each is normalised, and known licence sentences become identifiers (with the version
they name and their place). Sentences of a licence's own text are known by their words. A sentence that names a licence
is known if nothing but the name and words of such sentences (FILLER) is in it, or if it also says that something is
licensed (CUES); a name alone in other words is none, nor is one that a sentence denies (DENIES). The identifiers of a
text, in order, are then matched against ordered licence rules: a rule that matches a run of identifiers yields its
licence and takes them out, so longer, more particular rules come first. Sentences that speak of licensing but match
nothing known make the text ``UNKNOWN``. One pass, no shuffle.

Defined results: null and empty texts have no licence; licences are listed in the order in which the text first gives
them, each once; repeated rows give repeated rows; an empty table gives an empty table; sentences of any length are
read whole. Of the input only the key columns are kept; columns may have any names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean

#: Identifier and pattern of each known licence sentence, over normalised text. A group is the version.
SENTENCES = [
    ("agpl", r"gnu affero general public licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9](?:\.[0-9])?))?|\bagpl(?:[ -]?v?([0-9](?:\.[0-9])?))?"),
    ("lgpl", r"gnu (?:lesser|library) general public licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9](?:\.[0-9])?))?|\blgpl(?:[ -]?v?([0-9](?:\.[0-9])?))?"),
    ("gpl", r"gnu general public licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9](?:\.[0-9])?))?|\bgpl(?:[ -]?v?([0-9](?:\.[0-9])?))?"),
    ("later", r"\bor (?:\(at your option\) )?any later version"),
    ("apache", r"apache licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9](?:\.[0-9])?))?|apache-([0-9]\.[0-9])"),
    ("apache_copy", r"you may obtain a copy of the license at"),
    ("apache_terms", r"unless required by applicable law or agreed to in writing"),
    ("mit", r"\bmit licen[cs]e|\bmit-licensed|expat licen[cs]e"),
    ("mit_grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included"),
    ("isc_grant", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose"),
    ("as_is", r"(?:software|work) is provided (?:\W*as is\W*|by the copyright holders)"),
    ("bsd", r"\bbsd licen[cs]e|\bbsd-?([234])-clause|\b([234])-clause bsd"),
    ("bsd_source", r"redistributions of source code must retain"),
    ("bsd_binary", r"redistributions in binary form must reproduce"),
    ("bsd_names", r"(?:neither the name|names? of .{1,80}may not be used to endorse)"),
    ("mpl", r"mozilla public licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9]\.[0-9]))?|\bmpl(?:[ -]?v?([0-9]\.[0-9]))"),
    ("epl", r"eclipse public licen[cs]e(?:[ ,]*(?:v|version )? ?([0-9]\.[0-9]))?"),
    ("cc0", r"\bcc0\b|cc-zero|creative commons zero"),
    ("cc_by_nc_sa", r"\bcc[ -]by-nc-sa(?:[ -]([0-9]\.[0-9]))?|attribution-noncommercial-sharealike(?: ([0-9]\.[0-9]))?"),
    ("cc_by_nc_nd", r"\bcc[ -]by-nc-nd(?:[ -]([0-9]\.[0-9]))?|attribution-noncommercial-noderiv\w*(?: ([0-9]\.[0-9]))?"),
    ("cc_by_nc", r"\bcc[ -]by-nc(?!-[sn])(?:[ -]([0-9]\.[0-9]))?|attribution-noncommercial(?!-)(?: ([0-9]\.[0-9]))?"),
    ("cc_by_sa", r"\bcc[ -]by-sa(?:[ -]([0-9]\.[0-9]))?|attribution-sharealike(?: ([0-9]\.[0-9]))?"),
    ("cc_by_nd", r"\bcc[ -]by-nd(?:[ -]([0-9]\.[0-9]))?|attribution-noderiv\w*(?: ([0-9]\.[0-9]))?"),
    ("cc_by", r"\bcc[ -]by(?!-[ns])(?:[ -]([0-9]\.[0-9]))?|creative commons attribution(?!-)(?: ([0-9]\.[0-9]))?"),
    ("unlicense", r"\bthe unlicense\b|released into the public domain|dedicated to the public domain"),
    ("proprietary", r"proprietary and confidential|unauthorized copying of this"),
    ("reserved", r"all rights reserved"),
]
#: Identifiers of sentences that name a licence: other words may hold the same letters.
NAMES = {"agpl", "lgpl", "gpl", "apache", "mit", "bsd", "mpl", "epl", "cc0", "cc_by_nc_sa", "cc_by_nc_nd", "cc_by_nc", "cc_by_sa", "cc_by_nd", "cc_by"}
#: Words that a sentence which only names a licence may hold beside the name.
FILLER = r"^(?:[^\p{L}]+|\b(?:the|an?|this|that|these|its?|is|are|be|was|or|and|of|to|in|on|at|by|for|with|from|as|see|here|file|work|project|software|program|code|library|package|content|text|only|either|any|both|all|also|again|too|your?|our|option|later|versions?|v|licen[cs]e[ds]?|licensing|terms|conditions|details|international|generic|unported|public|domain|expat|clause)\b)*$"
#: Words that say that something is licensed.
CUES = r"\b(?:licen[cs]ed?|licen[cs]ing|sublicensed?|relicensed|released|(?:re)?distributed?|available|published|covered|governed|provided|offered|shared|permitted|granted|compliance|copyright|terms of|conditions of|under the|spdx\S*)\b"
#: What denies the words after it in its sentence, unless an exception follows.
DENIES = r"\b(?:not|never|no longer|cannot|isn't|aren't|wasn't|nor|unlike|instead of|rather than)\b(?!.*\b(?:except|unless|without)\b).*?"
#: Ordered rules over identifiers, each with the licence that it yields; $1 is the version.
RULES = [
    (r"<agpl:([^>]*)>(?:<gpl:[^>]*>|<agpl:[^>]*>)*(?:<later:>)", "AGPL-$1-or-later"),
    (r"<lgpl:([^>]*)>(?:<gpl:[^>]*>|<lgpl:[^>]*>)*(?:<later:>)", "LGPL-$1-or-later"),
    (r"<gpl:([^>]*)>(?:<gpl:[^>]*>)*(?:<later:>)", "GPL-$1-or-later"),
    (r"(?:<apache:([^>]*)>)+(?:<apache_copy:>|<apache_terms:>|<apache:[^>]*>|<as_is:>)*", "Apache-$1"),
    (r"(?:<mit:>)?<mit_grant:>(?:<mit_notice:>)?(?:<as_is:>)?", "MIT"),
    (r"<isc_grant:>(?:<as_is:>)?", "ISC"),
    (r"(?:<bsd:[^>]*>)?(?:<reserved:>)?<bsd_source:><bsd_binary:><bsd_names:>(?:<as_is:>)?", "BSD-3-clause"),
    (r"(?:<bsd:[^>]*>)?(?:<reserved:>)?<bsd_source:><bsd_binary:>(?:<as_is:>)?", "BSD-2-clause"),
    (r"<agpl:([^>]*)>", "AGPL-$1"),
    (r"<lgpl:([^>]*)>", "LGPL-$1"),
    (r"<gpl:([^>]*)>", "GPL-$1"),
    (r"<mit:>", "MIT"),
    (r"<bsd:([^>]*)>", "BSD-$1"),
    (r"<mpl:([^>]*)>", "MPL-$1"),
    (r"<epl:([^>]*)>", "EPL-$1"),
    (r"<cc0:>", "CC0"),
    (r"<cc_by_nc_sa:([^>]*)>", "CC-BY-NC-SA-$1"),
    (r"<cc_by_nc_nd:([^>]*)>", "CC-BY-NC-ND-$1"),
    (r"<cc_by_nc:([^>]*)>", "CC-BY-NC-$1"),
    (r"<cc_by_sa:([^>]*)>", "CC-BY-SA-$1"),
    (r"<cc_by_nd:([^>]*)>", "CC-BY-ND-$1"),
    (r"<cc_by:([^>]*)>", "CC-BY-$1"),
    (r"<unlicense:>", "Public-domain"),
    (r"<proprietary:>(?:<reserved:>)?", "Proprietary"),
    (r"<unknown:>", "UNKNOWN"),
]
#: Only texts that hold one of these are cut into sentences; every known sentence has one, or asks for a licence.
HINT = r"(?i)licen[cs]e|[al]?gpl|apache-|permission|redistribut|neither the name|endorse|provided|later version|applicable law|obtain a copy|bsd|mpl|creative commons|\bcc0|\bcc-zero|\bcc[ -]by|attribution-|public domain|proprietary|unauthori|rights reserved"
#: A sentence that speaks of a licence without any known one.
ASKS = r"\b(?:licen[cs]ed under|under the terms of|under the .{1,60}licen[cs]e)\b"
#: What the sentences are normalised by; the gate reads raw text, so each of its spaces may be any of these.
SPACE = r"[^\p{L}\p{N}.,;!?'()/+-]+"
#: Whether a raw text may hold a hint or ask; the other forms of ASKS hold a hint.
GATE = (HINT + r"|under the terms of").replace(r"\bcc[ -]by", r"\bcc(?: |-)by").replace(" ", SPACE)


def sentences(text: Column) -> Column:
    """Normalised sentences: lower case, other characters than letters, digits and a few marks as one space."""
    flat = F.regexp_replace(F.lower(text), SPACE, " ")
    return F.split(flat, r"(?<=[.!?;])\s+(?![0-9])")


def identifiers(text: Column) -> Column:
    """The text's licence sentences as one string of <id:version>, each with its place: sentence and letter."""

    def mark(name: str, pattern: str, sentence: Column, number: Column) -> Column:
        holds = F.rlike(sentence, F.lit(pattern))
        if name in NAMES or name == "unlicense":
            holds = holds & ~F.rlike(sentence, F.lit(f"{DENIES}(?:{pattern})"))
        if name in NAMES:
            rest = F.regexp_replace(sentence, pattern, " ")
            holds = holds & (F.rlike(rest, F.lit(FILLER)) | F.rlike(rest, F.lit(CUES)))
        place = F.concat(F.lpad(number.cast("string"), 8, "0"), F.lpad(F.regexp_instr(sentence, F.lit(pattern)).cast("string"), 8, "0"))
        return F.when(holds, F.concat(F.lit(f"<{name}:"), _version(sentence, pattern), F.lit(">"), place)).otherwise("")

    def known(sentence: Column, number: Column) -> Column:
        every = F.concat(*(mark(name, pattern, sentence, number) for name, pattern in SENTENCES))
        asks = F.rlike(sentence, F.lit(ASKS)) & ~F.rlike(sentence, F.lit(f"{DENIES}{ASKS}"))
        return F.when((every == "") & asks, F.concat(F.lit("<unknown:>"), F.lpad(number.cast("string"), 16, "0"))).otherwise(every)

    hinted = F.filter(sentences(text), lambda s: F.rlike(s, F.lit(HINT)) | F.rlike(s, F.lit(ASKS)))
    return F.when(F.rlike(text, F.lit(GATE)), F.array_join(F.transform(hinted, known), "")).otherwise("")


def _version(sentence: Column, pattern: str) -> Column:
    groups = pattern.count("([0-9") + pattern.count("([234")
    parts = [F.regexp_extract(sentence, pattern, k + 1) for k in range(groups)]
    return F.concat(*parts) if parts else F.lit("")


def match_rules(sequence: Column) -> Column:
    """The licences of a sequence of identifiers, by place: each rule takes out what it matches."""
    placed = [(re.sub(r"(?<!\^)>", r">\\d{16}", pattern), licence) for pattern, licence in RULES]
    rules = F.array(*(F.struct(F.lit(pattern).alias("pattern"), F.lit(licence).alias("licence")) for pattern, licence in placed))
    start = F.struct(sequence.alias("rest"), F.array().cast("array<struct<place:string,licence:string>>").alias("found"))

    def step(done: Column, rule: Column) -> Column:
        hits = F.regexp_extract_all(done["rest"], rule["pattern"], F.lit(0))
        licence = lambda h: F.regexp_replace(F.regexp_replace(h, rule["pattern"], rule["licence"]), r"-(?=-|$)", "")
        named = F.transform(hits, lambda h: F.struct(F.regexp_extract(h, r">(\d{16})", 1).alias("place"), licence(h).alias("licence")))
        # what is taken out leaves a mark, so that its neighbours do not become a run
        return F.struct(F.regexp_replace(done["rest"], rule["pattern"], F.lit(";")).alias("rest"), F.concat(done["found"], named).alias("found"))

    found = F.aggregate(rules, start, step, lambda done: F.array_distinct(F.transform(F.array_sort(done["found"]), lambda x: x["licence"])))
    return F.when(sequence == "", F.array().cast("array<string>")).otherwise(found)


def scan(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Per row: its keys, ``sentence_ids`` in order of the text, and ``licenses``."""
    own = [F.col(f"`{name}`").alias(f"in_{k}") for k, name in enumerate(keys)]  # names may clash with those made here
    found = df.select(*own, identifiers(clean(F.col(f"`{text_col}`"))).alias("ids"))
    ids = F.regexp_extract_all("ids", F.lit("<([^>]+)>"), F.lit(1))
    return found.select(*(F.col(f"in_{k}").alias(name) for k, name in enumerate(keys)), ids.alias("sentence_ids"), match_rules(F.col("ids")).alias("licenses"))
