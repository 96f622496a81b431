"""License templates against the licenses' own texts."""

from __future__ import annotations

import pyarrow as pa
import pytest

from turnmill.llm.licenses import PHRASES, TEMPLATES, scanner

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: A word of the last clause and what it is replaced by.
LICENSES = {
    "isc": (ISC, "PERFORMANCE", "LOSS"), "bsd": (BSD, "EVEN IF", "UNLESS"), "zlib": (ZLIB, "may not be removed", "may be removed"),
    "unlicense": (UNLICENSE, "OTHER DEALINGS", "DEALINGS"),
}


def scan(*texts):
    return scanner(TEMPLATES, PHRASES)(pa.array(texts, pa.string()))


@pytest.mark.parametrize("label", LICENSES)
def test_whole_license(label):
    text, last, other = LICENSES[label]
    altered, cut = text.replace(last, other), text[: text.rindex(last)]
    assert altered != text
    whole, *refused = scan(text, altered, cut)
    assert (whole["labels"], whole["score"]) == (label, 1.0)
    assert [r["labels"] for r in refused] == ["", ""]


def test_unlicense_address_and_zlib_spelling():
    more, spelled = scan(
        f"{UNLICENSE}\n\nFor more information, please refer to <https://unlicense.org>",
        ZLIB.replace("acknowledgment", "acknowledgement"),
    )
    assert (more["labels"], more["score"], spelled["labels"]) == ("unlicense", 1.0, "zlib")


def test_long_holders():
    notice = "Copyright (c) 2019 2024 The Free Software Foundation Inc and other contributors. All rights reserved"
    people = "COPYRIGHT HOLDERS, " + "AND ".join(["ONE OF MANY CONTRIBUTORS "] * 10)
    got = scan(notice, BSD.replace("COPYRIGHT HOLDER ", people), ISC.replace("THE AUTHOR", people))
    assert [(r["labels"], r["score"]) for r in got] == [("copyright-notice,reserved", 1.0), ("bsd", 1.0), ("isc", 1.0)]


def test_holder_ends_at_next_wording():
    row, none = scan("Copyright A. All rights reserved. Some prose. Copyright (c) B. All rights reserved.", "Copyright A")
    notices = [(m["first_word"], m["last_word"]) for m in row["matches"] if m["label"] == "copyright-notice"]
    assert notices == [(0, 4), (7, 12)]
    assert row["score"] == 11 / 13 and none["labels"] == ""


def test_empty_texts():
    assert [(r["n_words"], r["labels"], r["score"]) for r in scan(None, "", " \n")] == [(0, "", 0.0)] * 3
