"""Licence notices by likeness to templates, with DataFrame functions only (operator 9).

The whole text and the templates become words (letters and digits, lower case) and bags of word bigrams; a window of
words, across lines and paragraphs, is a notice where the Dice coefficient with a template is at least THRESHOLD. A
template of a bigrams can only reach t with t / (2 - t) * a to (2 - t) / t * a of them, and must share t / (2 - t) * a: a
text's bigrams that any template has are found in one pass, and templates without enough of theirs in any
stretch of their largest size are pruned. Windows start and end at bigrams of the template, as all best ones do; each start gives its best end.

Of windows that overlap the one stays that shares most: 2 * shared - t * (both sizes) is greatest.

All of it is one map over the scan, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import pick

THRESHOLD = 0.8

#: What notices say, after the licences' own wording.
TEMPLATES = {
    "0BSD": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "WTFPL": ["This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
}


def words(text: str) -> list[str]:
    return re.sub(r"[^\w]|_", " ", text.lower()).split()


def bigrams(ws: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def dice(a: list[str], b: list[str]) -> float:
    """Of two bags."""
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b)) if a and b else 0.0


class _Table:
    """The templates as SQL literals: of each its name, bigrams n, the least that a window must share, and its most bigrams;
    and each bigram's templates, with how many of it they have."""

    def __init__(self, templates: dict[str, list[str]], t: float) -> None:
        rows, self.of = [], {}
        for name, text in ((name, text) for name, texts in templates.items() for text in texts):
            bag = Counter(bigrams(words(text)))
            n = bag.total()
            low, high = math.ceil(t / (2 - t) * n - 1e-9), math.floor((2 - t) / t * n + 1e-9)
            rows.append((len(rows), name, n, math.ceil(t / 2 * (n + low) - 1e-9), high))
            for b, c in bag.items():
                self.of.setdefault(b, []).append((rows[-1][0], c))
        quoted = "'{}'".format
        self.bigrams = ", ".join(map(quoted, self.of))
        self.templates = "array(" + ", ".join(f"named_struct('t', {k}, 'name', {quoted(name)}, 'n', {n}, 'need', {need}, 'high', {high})" for k, name, n, need, high in rows) + ")"
        self.lookup = "map(" + ", ".join(f"{quoted(b)}, array(" + ", ".join(f"named_struct('t', {k}, 'c', {c})" for k, c in own) + ")" for b, own in self.of.items()) + ")"


def licence_scan(docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_notices, licence, dice, notices (array of at, words, licence, dice).

    Notices are windows that do not overlap, in the order of the text, at and words counted in its words; licence and dice are
    those of the likest notice (of equals the first). Null and empty texts and those without notices have none: 0, null,
    null and an empty array. Rows that repeat give the same; a null doc_id is like any other. Other columns are ignored; no
    rows give none.
    """
    rows = pick(docs, doc_id="bigint", text="string")
    table = _Table(templates or TEMPLATES, threshold)
    ws = rows.select("doc_id", F.expr("split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\\\p{L}\\\\p{N}]+', ' ')), ' ')").alias("ws"))
    pairs = ws.select("doc_id", F.expr("CASE WHEN size(ws) > 1 THEN zip_with(slice(ws, 1, size(ws) - 1), slice(ws, 2, size(ws) - 1), (a, b) -> concat(a, ' ', b)) ELSE array() END").alias("bs"))
    # the bigrams that any template has, at their places
    known = pairs.select("doc_id", F.expr(f"filter(transform(bs, (b, i) -> CASE WHEN b IN ({table.bigrams}) THEN struct(i, b) END), x -> x IS NOT NULL)").alias("known"))
    # of each template they belong to; c: how many of this one the template has
    entries = known.select("doc_id", F.expr(f"flatten(transform(known, x -> transform(element_at({table.lookup}, x.b), e -> struct(e.t, e.c, x.i, x.b))))").alias("entries"))
    # templates with enough of their bigrams in one window of their size
    near = "exists(sequence(0, size(f.hits) - f.need), j -> f.hits[j + f.need - 1].i - f.hits[j].i < f.high)"
    found = f"filter(transform({table.templates}, t -> struct(t.name, t.n, t.need, t.high, filter(entries, e -> e.t = t.t) AS hits)), f -> size(f.hits) >= f.need AND CASE WHEN size(f.hits) >= f.need THEN {near} END)"
    hits = entries.select("doc_id", F.expr(f"CASE WHEN size(entries) > 0 THEN {found} ELSE array() END").alias("found"))
    # q: the place of the c-th same bigram before; a window that holds it cannot count this one too
    same = "filter(slice(f.hits, greatest(1, j + 1 - f.high), least(j, f.high)), y -> y.b = x.b AND y.i < x.i)"
    spent = hits.select("doc_id", F.expr(f"transform(found, f -> struct(f.name, f.n, f.need, f.high, transform(f.hits, (x, j) -> struct(x.i, coalesce(get(transform({same}, y -> y.i), size({same}) - x.c), -1) AS q)) AS hits))").alias("found"))
    best = (
        "aggregate(slice(f.hits, j + 1, f.high), named_struct('cnt', 0, 'shared', 0, 'm', 0, 'dice', 0D), (s, y) -> CASE WHEN y.i - x.i + 1 > f.high THEN s ELSE"
        " CASE WHEN 2D * (s.cnt + int(y.q < x.i)) / (y.i - x.i + 1 + f.n) > s.dice"
        " THEN named_struct('cnt', s.cnt + int(y.q < x.i), 'shared', s.cnt + int(y.q < x.i), 'm', y.i - x.i + 1, 'dice', 2D * (s.cnt + int(y.q < x.i)) / (y.i - x.i + 1 + f.n))"
        " ELSE named_struct('cnt', s.cnt + int(y.q < x.i), 'shared', s.shared, 'm', s.m, 'dice', s.dice) END END)"
    )
    reach = "get(f.hits, j + f.need - 1).i - x.i + 1 <= f.high"
    each = f"flatten(transform(found, f -> transform(filter(transform(f.hits, (x, j) -> struct(x.i AS at, f.name AS licence, f.n AS n, CASE WHEN {reach} THEN {best} END AS w)), z -> z.w.dice >= {threshold}D - 1e-12D), z -> struct({threshold}D * (z.n + z.w.m) - 2D * z.w.shared AS less, z.at, z.licence, z.w.m + 1 AS words, z.w.dice AS dice))))"
    windows = spent.select("doc_id", F.expr(f"array_sort({each})").alias("windows"))
    kind = "array<struct<less:double,at:int,licence:string,words:int,dice:double>>"
    kept = f"aggregate(windows, cast(array() AS {kind}), (kept, w) -> CASE WHEN exists(kept, k -> w.at < k.at + k.words AND k.at < w.at + w.words) THEN kept ELSE concat(kept, array(w)) END)"
    apart = windows.select("doc_id", F.expr(kept).alias("kept"))
    notices = apart.select("doc_id", F.expr("array_sort(transform(kept, k -> struct(k.at, k.words, k.licence, k.dice)))").alias("notices"))
    first = notices.withColumn("top", F.when(F.size("notices") > 0, F.expr("notices[array_sort(transform(notices, (n, i) -> struct(-n.dice AS less, i AS i)))[0].i]")))
    return first.select("doc_id", F.size("notices").cast("long").alias("n_notices"), F.col("top.licence").alias("licence"), F.col("top.dice").alias("dice"), "notices")
