"""License scans: ordered signature rules over word-normalised text, in Spark functions only.

A text becomes its lower-case words separated by single spaces. A rule is a regular
expression over that form with a cue and a keyword, both plain substrings that any match
must contain; a document without any cue is done after a few substring searches, and a rule
runs only where its cue and its keyword occur. Each match is a range of words. A range
inside another one of the same or a higher priority is suppressed. All of it is evaluated
within the row: nothing is shuffled and no row needs another.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import ascii_lower

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LEVELS = 6
_BLOCK = 64

#: Phrases that are always reported, wherever their words stand consecutively.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label, keyword, the name as it is written, its SPDX identifier as words. All forms
#: of a row contain its keyword; where they share none, each has its own row (None: no form).
_NAMES = [
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit", "mit (?:no attribution|0)", "mit 0"),
    ("apache", "apache", "apache(?: software)?(?: foundation)?", None),
    ("apache-1.1", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?v?1 1", "apache 1 1"),
    ("apache-2", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?v?2(?: 0)?", "apache 2 0"),
    ("bsd", "bsd", "bsd", None),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd"),
    ("isc", "isc", "isc", "isc"),
    ("gpl", "gpl", "(?:gnu )?gpl", None),
    ("gpl", "general public", "(?:gnu )?general public licen[sc]e", None),
    ("gpl-1", "1", "(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? ?v?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2", "2", "(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? ?v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "3", "(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? ?v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", None),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public licen[sc]e", None),
    ("lgpl", "library general", "(?:gnu )?library general public licen[sc]e", None),
    ("lgpl-2", "2", "(?:gnu )?(?:lgpl|library general public licen[sc]e)(?: version| v)? ?v?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "2 1", "(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version| v)? ?v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "3", "(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: version| v)? ?v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl", "agpl", "(?:gnu )?agpl", None),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e", None),
    ("agpl-3", "3", "(?:gnu )?(?:agpl|affero general public licen[sc]e)(?: version| v)? ?v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "free documentation", "(?:gnu )?free documentation licen[sc]e", None),
    ("gfdl-1.3", "1", "(?:gnu )?(?:gfdl|free documentation licen[sc]e)(?: version| v)? ?v?1(?: [0-3])?", "gfdl 1 3(?: only| or later)?"),
    ("mpl", "mozilla", "mozilla public", None),
    ("mpl-1.1", "1 1", "(?:mpl|mozilla public licen[sc]e)(?: version| v)? ?v?1 1", "mpl 1 1"),
    ("mpl-2", "2", "(?:mpl|mozilla public licen[sc]e)(?: version| v)? ?v?2(?: 0)?", "mpl 2 0"),
    ("epl", "eclipse", "eclipse public", None),
    ("epl-1", "1", "(?:epl|eclipse public licen[sc]e)(?: version| v)? ?v?1(?: 0)?", "epl 1 0"),
    ("epl-2", "2", "(?:epl|eclipse public licen[sc]e)(?: version| v)? ?v?2(?: 0)?", "epl 2 0"),
    ("cpl-1", "common public", "common public licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("cpl-1", "cpl 1 0", None, "cpl 1 0"),
    ("cpal-1", "cpal", "cpal(?: 1 0)?", "cpal 1 0"),
    ("ipl-1", "ibm public", "ibm public licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("ipl-1", "ipl 1 0", None, "ipl 1 0"),
    ("cddl-1", "cddl", "cddl(?: version| v)? ?v?1(?: [01])?", "cddl 1 [01]"),
    ("cddl-1", "common development", "common development and distribution licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("eupl", "eupl", "eupl", None),
    ("eupl-1.1", "1 1", "(?:eupl|european union public licen[sc]e)(?: version| v)? ?v?1 1", "eupl 1 1"),
    ("eupl-1.2", "1 2", "(?:eupl|european union public licen[sc]e)(?: version| v)? ?v?1 2", "eupl 1 2"),
    ("cecill", "cecill", "cecill(?: [bc])?(?: version| v)?(?: ?v?2 [01])?", "cecill (?:2 [01]|b|c)"),
    ("mulan-2", "mulan", "mulan (?:psl|permissive software licen[sc]e)(?: ?v?2)?", "mulanpsl 2 0"),
    ("artistic", "artistic", "(?:perl )?artistic", "artistic 1 0"),
    ("artistic-2", "artistic", "artistic(?: licen[sc]e)?(?: version| v)? ?v?2(?: 0)?", "artistic 2 0"),
    ("bsl-1", "boost", "boost software licen[sc]e(?: version| v)?(?: ?v?1(?: 0)?)?", None),
    ("bsl-1", "boost", "boost", None),
    ("bsl-1", "bsl 1 0", None, "bsl 1 0"),
    ("busl-1.1", "business source", "business source(?: licen[sc]e)?(?: version| v)?(?: ?v?1 1)?", None),
    ("busl-1.1", "busl", "busl(?: ?v?1 1)?", "busl 1 1"),
    ("busl-1.1", "bsl 1 1", "bsl 1 1", None),
    ("sspl-1", "server side public", "server side public(?: licen[sc]e)?(?: version| v)?(?: ?v?1)?", None),
    ("sspl-1", "sspl", "sspl(?: version| v)?(?: ?v?1(?: 0)?)?", "sspl 1 0"),
    ("elastic-2", "elastic", "elastic(?: licen[sc]e)?(?: version| v)? ?v?2(?: 0)?", "elastic 2 0"),
    ("polyform", "polyform", "polyform (?:noncommercial|shield|small business|strict)(?: licen[sc]e)?(?: 1 0 0)?", "polyform (?:noncommercial|small business) 1 0 0"),
    ("commons-clause", "commons clause", "commons clause", None),
    ("hippocratic", "hippocratic", "hippocratic(?: licen[sc]e)?(?: ?v?[23](?: [01])?)?", "hippocratic 2 1"),
    ("ms-pl", "microsoft public", "microsoft public", None),
    ("ms-pl", "ms pl", "ms pl", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", None),
    ("ms-rl", "ms rl", "ms rl", "ms rl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("osl-3", "open software", "open software licen[sc]e(?: version| v)?(?: ?v?3 0)?", None),
    ("osl-3", "osl 3 0", "osl 3 0", "osl 3 0"),
    ("afl-3", "academic free", "academic free licen[sc]e(?: version| v)?(?: ?v?3 0)?", None),
    ("afl-3", "afl 3 0", "afl 3 0", "afl 3 0"),
    ("ecl-2", "educational community", "educational community licen[sc]e(?: version| v)?(?: ?v?2 0)?", None),
    ("ecl-2", "ecl 2 0", "ecl 2 0", "ecl 2 0"),
    ("upl-1", "universal permissive", "universal permissive licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("upl-1", "upl 1 0", "upl 1 0", "upl 1 0"),
    ("apsl-2", "apple public source", "apple public source licen[sc]e(?: version| v)?(?: ?v?2 0)?", None),
    ("apsl-2", "apsl 2 0", "apsl 2 0", "apsl 2 0"),
    ("lppl-1.3", "latex project public", "latex project public licen[sc]e(?: version| v)?(?: ?v?1 3[ac]?)?", None),
    ("lppl-1.3", "lppl", "lppl(?: ?v?1 3[ac]?)?", "lppl 1 3[ac]"),
    ("zpl-2.1", "zope public", "zope public licen[sc]e(?: version| v)?(?: ?v?2 1)?", None),
    ("zpl-2.1", "zpl 2 1", "zpl 2 1", "zpl 2 1"),
    ("qpl-1", "q public", "q public licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("qpl-1", "qpl 1 0", "qpl 1 0", "qpl 1 0"),
    ("sleepycat", "sleepycat", "sleepycat", "sleepycat"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("libpng-2", "libpng", "libpng(?: version 2)?", "libpng 2 0"),
    ("unlicense", "unlicen", "unlicen[sc]e", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: ?v?2)?", "wtfpl"),
    ("beerware", "beerware", "beerware", "beerware"),
    ("beerware", "beer ware", "beer ware", None),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python-2", "python", "python(?: software foundation)?", "python 2 0"),
    ("python-2", "psf 2 0", "psf 2 0", "psf 2 0"),
    ("php-3", "php", "php(?: licen[sc]e)?(?: version| v)? ?v?3(?: 0[01]?)?", "php 3 0[01]?"),
    ("ruby", "ruby", None, "ruby"),
    ("vim", "vim", None, "vim"),
    ("curl", "curl", None, "curl"),
    ("json", "json", None, "json"),
    ("icu", "icu", None, "icu"),
    ("ijg", "independent jpeg", "independent jpeg group", None),
    ("ijg", "ijg", None, "ijg"),
    ("ftl", "freetype", "freetype(?: project)?", None),
    ("ftl", "ftl", None, "ftl"),
    ("unicode", "unicode", "unicode(?: inc)?", "unicode (?:3 0|dfs 2016)"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)?", "w3c"),
    ("x11", "x11", "x11", "x11"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("blueoak", "blue oak", "blue oak model", None),
    ("blueoak", "blueoak", None, "blueoak 1 0 0"),
    ("ofl-1.1", "1 1", "(?:sil )?(?:ofl|open font licen[sc]e)(?: version| v)? ?v?1 1", "ofl 1 1"),
    ("ofl", "open font", "(?:sil )?open font", None),
    ("ogl", "open government", "open government licen[sc]e(?: version| v)?(?: ?v?[1-3] 0)?", None),
    ("odbl-1", "odbl", "odbl(?: version| v)?(?: ?v?1(?: 0)?)?", "odbl 1 0"),
    ("odbl-1", "open database", "open database licen[sc]e(?: version| v)?(?: ?v?1 0)?", None),
    ("odc-by", "odc by", "odc by(?: 1 0)?", "odc by 1 0"),
    ("odc-by", "open data commons attribution", "open data commons attribution", None),
    ("pddl-1", "pddl", "pddl(?: version| v)?(?: 1(?: 0)?)?", "pddl 1 0"),
    ("cdla", "cdla", "cdla (?:permissive|sharing)(?: [12] 0)?", "cdla (?:permissive|sharing) [12] 0"),
    ("cdla", "community data", "community data licen[sc]e agreement", None),
    ("cc", "creative commons", "creative commons", None),
    ("cc0-1", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc0-1", "creative commons zero", "creative commons zero(?: 1 0)?(?: universal)?", None),
    ("cc-pdm", "public domain mark", "(?:creative commons )?public domain mark(?: 1 0)?", None),
    ("cc-by", "cc by", "cc by(?: ?v?[1-4] [05])?", "cc by [1-4] [05]"),
    ("cc-by", "attribution", "creative commons attribution(?: ?v?[1-4] [05])?", None),
    ("cc-by-sa", "sa", "cc by sa(?: ?v?[1-4] [05])?", "cc by sa [1-4] [05]"),
    ("cc-by-sa", "alike", "creative commons attribution share ?alike(?: ?v?[1-4] [05])?", "cc by share alike"),
    ("cc-by-nd", "nd", "cc by nd(?: ?v?[1-4] [05])?", "cc by nd [1-4] [05]"),
    ("cc-by-nd", "derivatives", "creative commons attribution no ?derivatives(?: ?v?[1-4] [05])?", None),
    ("cc-by-nc", "nc", "cc by nc(?: ?v?[1-4] [05])?", "cc by nc [1-4] [05]"),
    ("cc-by-nc", "commercial", "creative commons attribution non ?commercial(?: ?v?[1-4] [05])?", "cc by non commercial"),
    ("cc-by-nc-sa", "nc sa", "cc by nc sa(?: ?v?[1-4] [05])?", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-sa", "alike", "creative commons attribution non ?commercial share ?alike(?: ?v?[1-4] [05])?", None),
    ("cc-by-nc-nd", "nc nd", "cc by nc nd(?: ?v?[1-4] [05])?", "cc by nc nd [1-4] [05]"),
    ("cc-by-nc-nd", "derivatives", "creative commons attribution non ?commercial no ?derivatives(?: ?v?[1-4] [05])?", None),
    ("llama", "llama", "llama(?: ?[23])?(?: [0-9])?(?: community)?", "llama [23]"),
    ("gemma", "gemma", "gemma", None),
    ("openrail", "openrail", "(?:creativeml |bigscience |bigcode )?openrail(?: m)?", "openrail(?: m)?"),
]

_ARTICLE = "(?:the |an? )?"
_OF_NAME = f"{_ARTICLE}(?:terms (?:and conditions )?of {_ARTICLE})?{{name}}"
_TAIL = "(?: (?:international|unported))?(?: licen[sc]es?)?"
_BETWEEN = "(?:[a-z0-9]+ ){1,12}?"
_OPERAND = "(?:(?!or |and )[a-z0-9]+ ){1,8}(?:or|and) "

#: Contexts of a name: kind, cue, pattern, priority, confidence. A joint name and an operand
#: reach back over the names in front of them, so they are weaker than those.
_CONTEXTS = [
    ("tag", "spdx licen", "spdx licen[sc]e identifier {spdx}", 5, 1.0),
    ("second operand", "spdx licen", f"spdx licen[sc]e identifier {_OPERAND}{{spdx}}", 4, 0.95),
    ("third operand", "spdx licen", f"spdx licen[sc]e identifier {_OPERAND * 2}{{spdx}}", 3, 0.95),
    ("fourth operand", "spdx licen", f"spdx licen[sc]e identifier {_OPERAND * 3}{{spdx}}", 2, 0.95),
    ("grant", "licensed under", f"licensed under (?:either (?:of )?|both )?{_OF_NAME}{_TAIL}", 4, 0.95),
    ("joint grant", "licensed under", f"licensed under {_BETWEEN}(?:and|or) {_ARTICLE}{{name}}(?: licen[sc]es?)?", 3, 0.9),
    ("release", "released under", f"released under {_OF_NAME}{_TAIL}", 4, 0.95),
    ("distribution", "distributed under", f"distributed under {_OF_NAME}{_TAIL}", 4, 0.95),
    ("offer", "available under", f"available under {_OF_NAME}{_TAIL}", 4, 0.9),
    ("terms", "terms", f"(?:subject to|governed by|under) the terms (?:and conditions )?of {_ARTICLE}{{name}}(?: licen[sc]es?)?", 3, 0.85),
    ("title", "licen", "(?:the )?{name} licen[sc]es?", 2, 0.7),
    ("joint title", "licen", f"{{name}} (?:and|or) {_BETWEEN}licen[sc]es?", 1, 0.6),
    ("field", "licen", "licen[sc]e {name}", 1, 0.5),
]

#: Addresses of license texts: label, pattern. The words up to the first bracket are the cue.
_ADDRESSES = [
    ("gpl-2", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu org licenses gpl 3 0"),
    ("gpl", "gnu org licenses gpl"),
    ("gpl", "gnu org copyleft gpl"),
    ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu org licenses lgpl"),
    ("agpl-3", "gnu org licenses agpl 3 0"),
    ("gfdl", "gnu org licenses fdl"),
    ("apache-2", "apache org licenses license 2 0"),
    ("apache-1.1", "apache org licenses license 1 1"),
    ("mit", "opensource org licenses? mit"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses? bsd 3 clause"),
    ("isc", "opensource org licenses? isc"),
    ("apache-2", "opensource org licenses? apache 2 0"),
    ("mpl-2", "opensource org licenses? mpl 2 0"),
    ("mpl-2", "mozilla org (?:en us )?mpl 2 0"),
    ("epl-1", "eclipse org legal epl v10"),
    ("epl-2", "eclipse org legal epl (?:2 0|v20)"),
    ("bsl-1", "boost org license 1 0"),
    ("unlicense", "unlicense org"),
    ("wtfpl", "wtfpl net"),
    ("cc0-1", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", "creativecommons org publicdomain mark 1 0"),
    ("cc-by", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("ofl-1.1", "scripts sil org ofl"),
    ("odbl-1", "opendatacommons org licenses odbl"),
    ("pddl-1", "opendatacommons org licenses pddl"),
    ("sspl-1", "mongodb com licensing server side public license"),
    ("elastic-2", "elastic co licensing elastic license"),
    ("polyform", "polyformproject org licenses"),
]

#: Titles and sentences of license texts: label, cue, pattern.
_SENTENCES = [
    ("mit", "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "substantial portions of the software", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-3-clause", "neither the name", "neither the name of .{1,80}? may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "bsd style", "bsd style licen[sc]e"),
    ("apache-2", "apache license version 2 0 january 2004", "apache license version 2 0 january 2004"),
    ("apache-2", "limitations under the license", "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl", "is free software", "(?:this program )?is free software you can redistribute it and or modify it"),
    ("gpl", "along with this program", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl-2", "version 2 of the license", "(?:either )?version 2 of the license(?: or at your option any later version)?"),
    ("gpl-3", "version 3 of the license", "(?:either )?version 3 of the license(?: or at your option any later version)?"),
    ("gpl-2", "version 2 june 1991", "gnu general public license version 2 june 1991"),
    ("gpl-3", "version 3 29 june 2007", "gnu general public license version 3 29 june 2007"),
    ("gpl", "gnu general public", "gnu general public license"),
    ("lgpl", "gnu lesser general", "gnu lesser general public license"),
    ("lgpl", "gnu library general", "gnu library general public license"),
    ("agpl", "gnu affero general", "gnu affero general public license"),
    ("agpl-3", "version 3 19 november 2007", "gnu affero general public license version 3 19 november 2007"),
    ("gfdl", "gnu free documentation", "gnu free documentation licen[sc]e"),
    ("mpl-2", "source code form is subject", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mozilla public licen", "mozilla public licen[sc]e"),
    ("epl", "eclipse public licen", "eclipse public licen[sc]e"),
    ("cddl-1", "common development and distribution licen", "common development and distribution licen[sc]e"),
    ("eupl", "european union public licen", "european union public licen[sc]e"),
    ("bsl-1", "boost software licen", "boost software licen[sc]e(?: version)? 1 0"),
    ("busl-1.1", "business source licen", "business source licen[sc]e"),
    ("sspl-1", "server side public licen", "server side public licen[sc]e"),
    ("elastic-2", "elastic licen", "elastic licen[sc]e (?:version )?2 0"),
    ("ms-pl", "microsoft public licen", "microsoft public licen[sc]e"),
    ("osl-3", "open software licen", "open software licen[sc]e(?: version| v)? 3 0"),
    ("afl-3", "academic free licen", "academic free licen[sc]e(?: version| v)? 3 0"),
    ("upl-1", "universal permissive licen", "universal permissive licen[sc]e"),
    ("ofl-1.1", "sil open font licen", "sil open font licen[sc]e(?: version)? 1 1"),
    ("lppl-1.3", "latex project public licen", "latex project public licen[sc]e"),
    ("qpl-1", "q public licen", "q public licen[sc]e version 1 0"),
    ("odbl-1", "open database licen", "open database licen[sc]e"),
    ("ogl", "open government licen", "open government licen[sc]e"),
    ("wtfpl", "you want to public", "do what the fuck you want to public licen[sc]e"),
    ("beerware", "buy me a beer", "you can buy me a beer in return"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:dedicated to|placed in|released into|in) the public domain"),
    ("zlib", "provided as is without", "this software is provided as is without any express or implied warranty"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such"),
    ("sspl-1", "make the functionality of the program", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "confidential and proprietary", "(?:is |are )?confidential and proprietary"),
]
_WEAK = {"gpl", "lgpl", "agpl", "gfdl", "bsd", "mpl", "epl", "eupl", "proprietary", "public-domain"}

_RULE_TYPE = (
    "array<struct<rule:string,label:string,cue:string,keyword:string,pattern:string,"
    "priority:int,confidence:double,base:boolean>>"
)


def rules() -> list[dict]:
    """All rules in order: base phrases, names in their contexts, addresses, sentences."""
    found = []

    def add(rule, label, cue, keyword, pattern, priority, confidence, base=False):
        found.append({
            "rule": rule, "label": label, "cue": cue, "keyword": keyword,
            # Matches start and end with whole words.
            "pattern": f"(?<![^ ])(?:{pattern})(?![^ ])",
            "priority": priority, "confidence": confidence, "base": base,
        })

    for phrase, label in BASE_PHRASES.items():
        add(f"base {label}", label, phrase, phrase, phrase, 3, 0.9, True)
    for kind, cue, context, priority, confidence in _CONTEXTS:
        for label, keyword, name, spdx in _NAMES:
            if (spdx if kind == "tag" or kind.endswith("operand") else name) is not None:
                pattern = context.replace("{name}", name or "").replace("{spdx}", spdx or "")
                add(f"{kind} {label}", label, cue, keyword, pattern, priority, confidence)
    for label, pattern in _ADDRESSES:
        cue = re.match("[a-z0-9 ]*[a-z0-9](?= |s[?]|$)", pattern)[0]
        add(f"address {label}", label, cue, cue, pattern, 4, 0.9)
    for label, cue, pattern in _SENTENCES:
        weak = label in _WEAK
        add(f"text {label}", label, cue, cue, pattern, 1 if weak else 4, 0.6 if weak else 0.95)
    return found


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _ranges(words: Column, rule: Column) -> Column:
    """The word ranges of a rule's matches, which are marked in the text and found as words."""
    marked = F.regexp_replace(words, rule["pattern"], F.lit("\x01$0\x02"))
    tokens = F.split(marked, " ")

    def places(test) -> Column:
        numbers = F.transform(tokens, lambda word, i: F.when(test(word), i))
        return F.filter(numbers, lambda i: i.isNotNull())

    spans = F.arrays_zip(
        places(lambda word: F.startswith(word, F.lit("\x01"))).alias("start"),
        places(lambda word: F.endswith(word, F.lit("\x02"))).alias("last"),
    )
    return F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"), (-span["last"] - 1).alias("before"),
            (-rule["priority"]).alias("rank"), rule["rule"].alias("rule"),
            (span["last"] + 1).alias("end"), rule["label"].alias("label"),
            rule["priority"].alias("priority"), rule["confidence"].alias("confidence"),
            rule["base"].alias("base"),
        ),
    )


def _unsuppressed(ordered: Column, kind: str) -> Column:
    """Of ranges by start, longest and strongest first: those in no other of their priority
    or above. Only an earlier range can contain a later one, so the furthest end so far at
    each priority decides. What stays is gathered in blocks, as each step copies its array."""

    def start(ends: Column, kept: str) -> Column:
        return F.struct(ends.alias("ends"), F.array().cast(kept).alias("kept"))

    def step(state: Column, item: Column) -> Column:
        above = F.slice(state["ends"], item["priority"] + 1, F.lit(_LEVELS))
        stays = item["base"] | (F.array_max(above) < item["end"])
        return F.struct(
            F.transform(
                state["ends"],
                lambda end, level: F.when(
                    level == item["priority"], F.greatest(end, item["end"])
                ).otherwise(end),
            ).alias("ends"),
            F.when(stays, F.concat(state["kept"], F.array(item))).otherwise(state["kept"])
            .alias("kept"),
        )

    def block(state: Column, first: Column) -> Column:
        own = F.slice(ordered, first, F.lit(_BLOCK))
        done = F.aggregate(own, start(state["ends"], kind), step)
        return F.struct(
            done["ends"].alias("ends"),
            F.concat(state["kept"], F.array(done["kept"])).alias("kept"),
        )

    firsts = F.sequence(F.lit(1), F.greatest(F.size(ordered), F.lit(1)), F.lit(_BLOCK))
    none = F.array_repeat(F.lit(-1), _LEVELS)
    return F.aggregate(
        firsts, start(none, f"array<{kind}>"), block, lambda state: F.flatten(state["kept"])
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``detections``.

    A detection has start and end (words from 0, end exclusive), label, rule, priority,
    confidence and base; they come in order of start. Equal ranges of equal priority keep
    the rule that is first by name. Base phrases are never suppressed. NULL and empty
    texts have no words and no detections. Columns of the new names are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_words", "detections")]
    listed = rules()
    literal = F.from_json(F.lit(json.dumps(listed)), _RULE_TYPE)
    cues = sorted({rule["cue"] for rule in listed})
    marks = F.lit(cues + sorted({rule["keyword"] for rule in listed} - set(cues)))
    words = F.trim(F.regexp_replace(ascii_lower(F.col(text)), _SEPARATORS, " "))
    normal = docs.select(*names, words.alias("__rw_words"))
    gate = F.lit(False)
    # A cue that contains another one adds nothing to the gate.
    for cue in [c for c in cues if not any(o != c and o in c for o in cues)]:
        gate |= F.contains("__rw_words", F.lit(cue))
    present = F.filter(marks, lambda mark: F.contains(F.col("__rw_words"), mark))
    gated = normal.withColumn("__rw_present", F.when(gate, present))
    active = F.filter(
        literal,
        lambda rule: F.array_contains(F.col("__rw_present"), rule["cue"])
        & F.array_contains(F.col("__rw_present"), rule["keyword"]),
    )
    found = F.array_sort(
        F.flatten(F.transform(active, lambda rule: _ranges(F.col("__rw_words"), rule)))
    )
    ordered = gated.withColumn("__rw_found", F.when(F.col("__rw_present").isNotNull(), found))
    kind = (
        "array<struct<start:int,before:int,rank:int,rule:string,end:int,label:string,"
        "priority:int,confidence:double,base:boolean>>"
    )
    kept = F.coalesce(_unsuppressed(F.col("__rw_found"), kind), F.array().cast(kind))
    count = F.when(F.col("__rw_words") == "", 0).otherwise(_spaces(F.col("__rw_words")) + 1)
    return ordered.select(
        *names, count.cast("long").alias("n_words"),
        F.transform(kept, lambda d: F.struct(*[
            d[name].alias(name)
            for name in ("start", "end", "label", "rule", "priority", "confidence", "base")
        ])).alias("detections"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def report(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: base places, labels and the strongest detection's confidence."""
    based = scanned.withColumn("__rw_base", F.filter("detections", lambda d: d["base"]))
    starts = F.transform("__rw_base", lambda d: d["start"])
    return based.select(
        doc_id, "n_words",
        F.size("__rw_base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        _joined(F.transform("__rw_base", lambda d: d["label"])).alias("base_labels"),
        _joined(F.transform("detections", lambda d: d["label"])).alias("labels"),
        F.coalesce(
            F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)
        ).alias("score"),
    )
