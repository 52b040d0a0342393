"""Licence scan: sentences to known identifiers, identifier sequences against ordered rules.

Texts are split at sentence ends and normalised; each known sentence gets its identifier, and
the identifiers, in the order of the text, are matched against rules, which are sequences of identifiers.
A known sentence may be wrapped: it begins at a line's beginning or after a semicolon, ends at a line's end, and
may run over line breaks, blank lines and comment marks in between (of other characters than letters and digits).
Sentences that are not known are passed over, so a rule may span text of other kinds. Only DataFrame
functions are used, a row at a time: no shuffle at all. n_sentences counts a line's end as a sentence's end,
so that each line of a wrapped sentence counts.

The version of a licence comes from a sentence that states it; a notice that states none is named without one.

Edge cases: null and empty texts have no sentences and no licence; texts of any length are searched whole; ids may be
null or repeat, each row being a document of its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, lower-cased, other than letters and digits as spaces.
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "this work is licensed under the gnu general public license version 3",
    3: "released under the mit license",
    4: "licensed under cc by nc 4 0",
    5: "licensed under cc by 4 0",
    6: "licensed under cc by sa 4 0",
    7: "licensed under the mit license",
    8: "all rights reserved",
    9: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    10: "you may not use this file except in compliance with the license",
    11: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    12: "see the license for the specific language governing permissions and limitations under the license",
    13: "either version 3 of the license or at your option any later version",
    14: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    15: "see the gnu general public license for more details",
    16: "you should have received a copy of the gnu general public license along with this program",
    17: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    18: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    19: "spdx license identifier mit",
    20: "spdx license identifier apache 2 0",
    21: "spdx license identifier gpl 3 0 or later",
    22: "this work is licensed under a creative commons attribution 4 0 international license",
    23: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    24: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    25: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    26: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    27: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    28: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    29: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    30: "this source code form is subject to the terms of the mozilla public license v",
    31: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    32: "this is free and unencumbered software released into the public domain",
    33: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    34: "this software is provided as is without any express or implied warranty",
    35: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    36: "you may obtain a copy of the license at https www apache org licenses license 2 0",
    37: "spdx license identifier bsd 2 clause",
    38: "spdx license identifier bsd 3 clause",
    39: "spdx license identifier gpl 2 0 only",
    40: "spdx license identifier gpl 2 0 or later",
    41: "spdx license identifier gpl 3 0 only",
    42: "spdx license identifier lgpl 2 1 or later",
    43: "spdx license identifier agpl 3 0 or later",
    44: "spdx license identifier mpl 2 0",
    45: "spdx license identifier isc",
    46: "spdx license identifier unlicense",
    47: "spdx license identifier zlib",
    48: "spdx license identifier cc0 1 0",
    49: "licensed under the educational community license version 2 0",
    50: "spdx license identifier ecl 2 0",
}

# Licence, and the sentences that show it, in order.
RULES = (
    ("Apache-2.0", (1,)),
    ("Apache-2.0", (10, 11)),
    ("Apache-2.0", (10, 36)),
    ("Apache-2.0", (20,)),
    ("AGPL-3.0-or-later", (29,)),
    ("AGPL-3.0-or-later", (43,)),
    ("BSD-2-Clause", (17, 18)),
    ("BSD-2-Clause", (37,)),
    ("BSD-3-Clause", (17, 18, 33)),
    ("BSD-3-Clause", (38,)),
    ("CC0-1.0", (48,)),
    ("CC-BY-4.0", (5,)),
    ("CC-BY-4.0", (22,)),
    ("CC-BY-NC-4.0", (4,)),
    ("CC-BY-SA-4.0", (6,)),
    ("ECL-2.0", (49,)),
    ("ECL-2.0", (50,)),
    ("GPL-3.0", (2,)),
    ("GPL", (14, 15, 16)),
    ("GPL-2.0-only", (26,)),
    ("GPL-2.0-only", (39,)),
    ("GPL-2.0-or-later", (25,)),
    ("GPL-2.0-or-later", (40,)),
    ("GPL-3.0-only", (41,)),
    ("GPL-3.0-or-later", (13, 14)),
    ("GPL-3.0-or-later", (21,)),
    ("GPL-3.0-or-later", (24,)),
    ("ISC", (31,)),
    ("ISC", (45,)),
    ("LGPL-2.1-or-later", (27,)),
    ("LGPL-2.1-or-later", (42,)),
    ("LGPL-3.0-or-later", (28,)),
    ("MIT", (3,)),
    ("MIT", (7,)),
    ("MIT", (9, 23)),
    ("MIT", (19,)),
    ("MPL-2.0", (30,)),
    ("MPL-2.0", (44,)),
    ("Proprietary", (8,)),
    ("Unlicense", (32,)),
    ("Unlicense", (46,)),
    ("Zlib", (34, 35)),
    ("Zlib", (47,)),
)

# A licence whose sentences are part of longer notices, and the licences of those notices, beside which it is not named.
PART_OF = {
    "BSD-2-Clause": ("BSD-3-Clause",),
    "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
}

_STOP = r"[.!?][ \t\r\n]+"


def normalised(sentence: Column) -> Column:
    """Lower-case letters and digits, anything else as one space. Once only ASCII is left, lower() is exact."""
    return F.trim(F.lower(F.regexp_replace(sentence, "[^A-Za-z0-9]+", " ")))


def license_scan(docs: DataFrame, known: dict[int, str] = SENTENCES, rules: tuple = RULES) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_sentences, sentence_ids, licenses (both arrays)."""
    table = F.create_map(*[F.lit(x) for k, s in known.items() for x in (s, k)])
    # Stretches end at . ! or ? before white space; within one, every line with a letter or digit counts as a sentence.
    split = docs.select("doc_id", F.split(F.coalesce("text", F.lit("")), _STOP).alias("stretches"))
    lines = F.filter(F.flatten(F.transform("stretches", lambda x: F.split(x, r"\n+"))), lambda x: x.rlike("[A-Za-z0-9]"))
    # Only a stretch that holds the longest word of a known sentence can hold it; the others need no normalising.
    words = "(?i)" + "|".join(sorted({max(s.split(), key=len) for s in known.values()}))
    likely = F.filter("stretches", lambda x: x.rlike(words))
    # Marks are gone, but line breaks and semicolons stay: known sentences are looked for between them, and over them.
    plain = F.transform(likely, lambda x: F.lower(F.regexp_replace(x, r"[^A-Za-z0-9\n;]+", " ")))
    longest_first = sorted(known.values(), key=len, reverse=True)
    pattern = r"(?:^|[\n;]) *(" + "|".join(s.replace(" ", r"[ \n;]++") for s in longest_first) + r")(?=[ ;]*(?:\n|\z))"
    found = F.flatten(F.transform(plain, lambda x: F.regexp_extract_all(x, F.lit(pattern), F.lit(1))))
    ids = F.array_compact(F.transform(found, lambda x: F.try_element_at(table, normalised(x))))
    seen = split.select("doc_id", F.size(lines).cast("long").alias("n_sentences"), ids.alias("sentence_ids"))
    line = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    found = F.array_compact(F.array(*[F.when(line.contains("," + ",".join(map(str, seq)) + ","), name) for name, seq in rules]))
    names = F.array_sort(F.array_distinct(found))
    for part, whole in PART_OF.items():
        names = F.when(F.arrays_overlap(names, F.array(*map(F.lit, whole))), F.array_remove(names, part)).otherwise(names)
    return seen.withColumn("licenses", names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_sentences", F.array_join(F.col("sentence_ids").cast("array<string>"), ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    table = "MAP {" + ", ".join(f"'{s}': {k}" for k, s in SENTENCES.items()) + "}"
    rules = ", ".join(f"CASE WHEN contains(line, ',{','.join(map(str, seq))},') THEN '{name}' END" for name, seq in RULES)
    names = f"list_sort(list_distinct(list_filter([{rules}], lambda x: x IS NOT NULL)))"
    for part, whole in PART_OF.items():
        names = f"list_filter({names}, lambda x: x <> '{part}' OR NOT list_has_any([{rules}], {list(whole)}))"
    return f"""
WITH s AS (
  SELECT doc_id, list_filter(list_transform(string_split(lower(regexp_replace(regexp_replace(coalesce(text, ''), '[.!?][ \t\r\n]+|\n+', chr(1), 'g'),
    '[^A-Za-z0-9\x01]+', ' ', 'g')), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS sentences FROM documents),
k AS (SELECT doc_id, len(sentences) AS n, list_filter(list_transform(sentences, lambda x: {table}[x]), lambda x: x IS NOT NULL) AS ids FROM s),
l AS (SELECT *, ',' || array_to_string(ids, ',') || ',' AS line FROM k)
SELECT doc_id, n::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string({names}, ',') AS licenses
FROM l
"""


SQL = _sql()
