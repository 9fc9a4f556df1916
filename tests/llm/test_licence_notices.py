"""Usual notices, licence expressions and what is none."""

import pytest

from mensura.llm import licenses as L

NOTICES = {
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.": "MPL-2.0",
    "/* This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n"
    " * version 2.1 of the License, or (at your option) any later version.\n */": "LGPL-2.1-or-later",
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": "Apache-2.0 OR MIT",
    "Licensed under either of the Apache License, Version 2.0\nor the MIT license, at your option.": "Apache-2.0 OR MIT",
    "Dual licensed under the MIT and GPL v2 licenses.": "MIT OR GPL-2.0",
    "// SPDX-License-Identifier: Apache-2.0 OR MIT": "Apache-2.0 OR MIT",
    "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later",
    "/* SPDX-License-Identifier: GPL-2.0+ */": "GPL-2.0-or-later",
    "SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR MIT": "GPL-2.0-only WITH Classpath-exception-2.0 OR MIT",
    "SPDX-License-Identifier: 0BSD": "0BSD",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.": "LicenseRef-BSD-style",
    "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt)": "BSL-1.0",
    "Licensed under the GPL v2 or later.": "GPL-2.0-or-later",
    "Released under the MIT License, see LICENSE for details.": "MIT",
}
NONE = ["This is not licensed under the MIT license.", "SPDX-License-Identifier: Foo-1.0", "SPDX-License-Identifier: MIT OR", "SPDX-License-Identifier: MIT XOR ISC",
        "Licensed under the foo or MIT license.", "either of Apache License, Version 2.0 or MIT", "a BSD-style building", "v. 2.0", ""]


@pytest.mark.parametrize("text", NOTICES, ids=range(len(NOTICES)))
def test_notice(text):
    before = "Some prose stands here. "
    for t in (text, before + text, "Title\n\n" + text + "\n\nMore prose."):
        found = L.recognise(t)[1]
        assert [f[0] for f in found] == [NOTICES[text]]
        assert 0 <= found[0][1] < found[0][2] <= len(t)


@pytest.mark.parametrize("text", NONE)
def test_no_notice(text):
    assert L.recognise(text)[1] == []


def test_notices_reach_the_query(spark, frame):
    rows = [(i, "Prose. " + t) for i, t in enumerate([*NOTICES, *NONE])]
    got = {r.doc_id: r for r in L.scan(frame(rows)).collect()}
    assert [got[i].licenses for i in range(len(rows))] == [*NOTICES.values(), *[""] * len(NONE)]


def test_a_long_unknown_sentence_is_read_once_through():
    assert L.recognise("licensed under the " + "very " * 20_000 + "long name")[1] == []
    assert L.recognise(("licensed under the\n" + "word\n" * 5) * 3000)[1] == []
