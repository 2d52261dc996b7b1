"""License scans by ordered signature rules.  DataFrame operations only; the
plan has no shuffle.

A text is brought down to its words, parted by single blanks.  Only texts that
hold one of a few gate words go on, and of the rules only those whose keyword
the text holds are tried: sentences of license texts and headers (``SIGNATURES``),
short names (``SPDX``), notices, and names in the usual phrases (``SHAPES``).  A rule is a regular expression with a label and a
priority.  All its matches give intervals of words.  A detection goes if another
of better priority, or one that is longer at the same priority, contains
it; what remains gives labels and a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# label, name as its words stand in running text (a pattern), keyword: a start of a word in every match
FAMILIES = [
    ("mit", "mit", "mit"), ("apache", "apache", "apache"), ("gpl", "gnu (?:gpl|general public)", "gnu"), ("gpl", "gpl", "gpl"), ("gpl", "general public", "general"),
    ("lgpl", "gnu (?:lgpl|(?:lesser|library) general public)", "gnu"), ("lgpl", "lgpl", "lgpl"), ("lgpl", "lesser general public", "lesser"),
    ("lgpl", "library general public", "library"), ("agpl", "gnu (?:agpl|affero general public)", "gnu"), ("agpl", "agpl", "agpl"),
    ("agpl", "affero general public", "affero"), ("bsd", "(?:new |simplified |modified |revised )?bsd", "bsd"), ("isc", "isc", "isc"), ("mpl", "mpl", "mpl"),
    ("mpl", "mozilla public", "mozilla"), ("epl", "epl", "epl"), ("epl", "eclipse public", "eclipse"), ("cddl", "cddl", "cddl"),
    ("cddl", "common development and distribution", "common"), ("cpl", "cpl", "cpl"), ("cpl", "common public", "common"), ("eupl", "eupl", "eupl"),
    ("eupl", "european union public", "european"), ("zlib", "zlib(?: libpng)?", "zlib"), ("boost", "boost(?: software)?", "boost"),
    ("artistic", "artistic", "artistic"), ("unlicense", "unlicense", "unlicense"), ("wtfpl", "wtfpl", "wtfpl"),
    ("python", "python software foundation", "python"), ("python", "psf", "psf"), ("php", "php", "php"), ("ruby", "ruby", "ruby"), ("openssl", "openssl", "openssl"),
    ("w3c", "w3c", "w3c"), ("ofl", "ofl", "ofl"), ("ofl", "(?:sil )?open font", "open"), ("ncsa", "ncsa", "ncsa"), ("ncsa", "university of illinois", "university"),
    ("postgresql", "postgresql", "postgresql"), ("vim", "vim", "vim"), ("afl", "afl", "afl"), ("afl", "academic free", "academic"), ("osl", "osl", "osl"),
    ("osl", "open software", "open"), ("bsl", "business source", "business"), ("sspl", "sspl", "sspl"), ("sspl", "server side public", "server"),
    ("elastic", "elastic", "elastic"), ("odbl", "odbl", "odbl"), ("odbl", "open database", "open"), ("x11", "x11", "x11"), ("curl", "curl", "curl"),
    ("ms-pl", "microsoft public", "microsoft"), ("cecill", "cecill", "cecill"), ("mulan", "mulan(?: permissive software)?", "mulan"), ("beerware", "beerware", "beerware"),
    ("cc0", "cc0", "cc0"), ("cc0", "creative commons zero", "creative"), ("cc-by", "cc by", "cc"), ("cc-by", "creative commons attribution", "creative"),
    ("cc-by-sa", "cc by sa", "cc"), ("cc-by-sa", "creative commons attribution share ?alike", "creative"),
    ("cc-by-nc", "cc by nc", "cc"), ("cc-by-nc", "creative commons attribution non ?commercial", "creative"),
    ("cc-by-nd", "cc by nd", "cc"), ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s", "creative"),
    ("cc-by-nc-sa", "cc by nc sa", "cc"), ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike", "creative"),
    ("cc-by-nc-nd", "cc by nc nd", "cc"), ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", "creative"),
]

# priority (1: best), confidence, pattern around the name
SHAPES = [
    (1, 0.99, "spdx license identifier (?:{name})(?: [0-9]+){{0,2}}"),
    (1, 0.97, "(?:licensed|released|distributed|available|redistributed) under (?:the )?(?:terms of the )?(?:{name})(?: licen[sc]e)?(?: (?:version |v)?[0-9]+(?: [0-9]+)?)?"),
    (1, 0.95, "(?:permission|rights|use) (?:is|are) (?:hereby )?granted under (?:the )?(?:{name})(?: licen[sc]e)?"),
    (2, 0.85, "(?:{name}) licen[sc]es? (?:version |v)?[0-9]+(?: [0-9]+)?"),
    (3, 0.70, "(?:{name}) licen[sc]es?"),
]

# rules that stand by themselves: label, keyword, priority, confidence, pattern
NOTICES = [
    ("proprietary", "reserved", 2, 0.60, "all rights reserved"),
    ("mit", "hereby", 1, 0.90, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution", 1, 0.90, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "redistribute", 1, 0.90, "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("apache", "compliance", 1, 0.90, "you may not use this file except in compliance with the license"),
    ("public-domain", "domain", 2, 0.75, "(?:dedicated to|released into|in) the public domain"),
    ("unlicense", "unencumbered", 1, 0.90, "free and unencumbered software released into the public domain"),
    ("copyright", "copyright", 3, 0.30, "copyright (?:c )?[0-9]{4}"),
]

# sentences of license texts and file headers, priority 1: label, then (keyword, pattern) of each
SIGNATURES = {
    "mit": [("sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
            ("substantial", "permission notice shall be included in all copies or substantial portions of the software"),
            ("whom", "to permit persons to whom the software is furnished to do so subject to"),
            ("noninfringement", "warranties of merchantability fitness for a particular purpose and noninfringement"),
            ("claim", "copyright holders be liable for any claim damages or other liability"),
            ("deal", "to deal in the software without restriction including without limitation the rights"),
            ("expat", "expat licen[sc]e")],
    "bsd": [("retain", "redistributions of source code must retain the (?:above|accompanying) copyright notice"),
            ("reproduce", "redistributions in binary form must reproduce the (?:above|accompanying) copyright notice"),
            ("endorse", "(?:names?|names of its contributors) may (?:not )?be used to endorse or promote products derived from this software without specific prior written permission"),
            ("acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
            ("copyright", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
            ("regents", "provided by the regents and contributors as is and any express or implied warranties"),
            ("procurement", "liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement"),
            ("clause", "(?:two|three|four|2|3|4) clause bsd licen[sc]e"),
            ("bsd", "bsd (?:two|three|four|2|3|4) clause (?:new |simplified |original )?licen[sc]e"),
            ("style", "(?:a|the) bsd style licen[sc]e"),
            ("berkeley", "copyright c? ?(?:[0-9]{4} )*(?:the )?regents of the university of california berkeley")],
    "isc": [("fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
            ("disclaims", "the author disclaims all warranties with regard to this software"),
            ("internet", "internet (?:systems|software) consortium licen[sc]e")],
    "apache": [("unless", "unless required by applicable law or agreed to in writing software distributed under the license"),
               ("governing", "see the license for the specific language governing permissions and limitations"),
               ("obtain", "you may obtain a copy of the license at http www apache org licenses"),
               ("contributor", "licensed to the apache software foundation asf under one or more contributor license agreements"),
               ("perpetual", "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
               ("irrevocable", "no charge royalty free irrevocable except as stated in this section patent license"),
               ("asf", "asf licenses this file to you under the apache license"),
               ("notice", "works shall retain the notice file of the apache license"),
               ("asl", "asl 2 0 licen[sc]e")],
    "gpl": [("hope", "distributed in the hope that it will be useful but without any warranty without even the implied warranty"),
            ("received", "you should have received a copy of the gnu general public license along with"),
            ("verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
            ("option", "either version [123] of the license or at your option any later version"),
            ("copyleft", "the (?:gnu )?general public license is a free copyleft license"),
            ("freedom", "the licenses for most software (?:and other practical works )?are designed to take away your freedom"),
            ("gplv", "gplv[123] licen[sc]e"),
            ("classpath", "gpl with (?:the )?classpath exception licen[sc]e"),
            ("linking", "linking this library statically or dynamically with other modules is making a combined work licensed"),
            ("conveying", "conveying under any other circumstances is permitted solely under the conditions stated below sublicensing"),
            ("subject", "the terms of the gnu general public license subject to the following exception"),
            ("franklin", "if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa for the license")],
    "lgpl": [("lesser", "you should have received a copy of the gnu lesser general public license along with"),
             ("library", "you should have received a copy of the gnu library general public license along with"),
             ("incorporates", "this version of the gnu lesser general public license incorporates the terms"),
             ("lgplv", "lgplv[23] licen[sc]e"),
             ("successor", "the successor of the gnu library public license"),
             ("redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license")],
    "agpl": [("affero", "you should have received a copy of the gnu affero general public license along with"),
             ("remotely", "remotely through a computer network (?:.{0,80} )?receive the corresponding source (?:.{0,80} )?license"),
             ("agplv", "agplv3 licen[sc]e"),
             ("redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license")],
    "gfdl": [("invariant", "with no invariant sections no front cover texts and no back cover texts a copy of the license"),
             ("documentation", "gnu free documentation licen[sc]e"),
             ("document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
             ("gfdl", "(?:the )?gfdl licen[sc]e")],
    "mpl": [("mozilla", "this source code form is subject to the terms of the mozilla public license"),
            ("file", "if a copy of the mpl was not distributed with this file you can obtain one at (?:.{0,40} )?licen[a-z]*"),
            ("incompatible", "this source code form is incompatible with secondary licenses"),
            ("contents", "the contents of this file are subject to the mozilla public license"),
            ("alternatively", "alternatively the contents of this file may be used under the terms of either the gnu general public license")],
    "epl": [("accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
            ("distribution", "eclipse distribution licen[sc]e"),
            ("agreement", "the accompanying program is provided under the terms of this eclipse public license agreement")],
    "cddl": [("development", "the contents of this file are subject to the terms of the common development and distribution license"),
             ("glassfish", "obtain a copy of the license at (?:.{0,60} )?glassfish"),
             ("opensolaris", "you can obtain a copy of the license at usr src opensolaris license"),
             ("brackets", "fields enclosed by brackets (?:.{0,120} )?copyright")],
    "cpl": [("accompanying", "the accompanying program is provided under the terms of this common public license")],
    "ipl": [("ibm", "ibm public licen[sc]e")],
    "eupl": [("approved", "licensed under the eupl version 1 [12] or as soon they will be approved by the european commission"),
             ("licence", "european union public licence")],
    "zlib": [("misrepresented", "the origin of this software must not be misrepresented (?:.{0,400} )?(?:source distribution|copyright)"),
             ("altered", "altered source versions must be plainly marked as such (?:.{0,200} )?redistribut[a-z]*|this notice may not be removed or altered from any source distribution under zlib license"),
             ("express", "software is provided as is without any express or implied warranty in no event will the authors be held liable")],
    "boost": [("boost", "distributed under the boost software license version 1 0 see accompanying"),
              ("machine", "solely in the form of machine executable object code generated by a source language processor (?:.{0,40} )?licen[a-z]*|copyright notices in the software (?:.{0,120} )?machine executable object code")],
    "artistic": [("artistic", "under the terms of (?:either )?the (?:perl )?artistic license"),
                 ("perl", "redistribute it and or modify it under the same terms as perl itself"),
                 ("perl", "same terms as the perl 5 programming language system itself (?:.{0,20} )?licen[a-z]*")],
    "unlicense": [("relinquish", "relinquishment in perpetuity of all present and future rights to this software under copyright law"),
                  ("anyone", "anyone is free to copy modify publish use compile sell or distribute this software (?:.{0,200} )?public domain"),
                  ("dedicat", "we make this dedication for the benefit of the public at large (?:.{0,120} )?copyright|dedicate any and all copyright interest in the software to the public domain")],
    "wtfpl": [("fuck", "do what the fuck you want to public license"),
              ("verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed")],
    "python": [("psf", "psf license agreement for python"), ("psf", "psf hereby grants licensee a nonexclusive royalty free"),
               ("beopen", "beopen python open source license agreement"), ("cnri", "cnri license agreement for python"),
               ("stichting", "copyright (?:c )?(?:[0-9]{4} )*stichting mathematisch centrum")],
    "php": [("php", "this source file is subject to version 3 0?1? ?of the php license"), ("php", "this product includes php software freely available from (?:.{0,40} )?licen[a-z]*|php license version 3 01")],
    "ruby": [("either", "you can redistribute it and or modify it under either the terms of the (?:ruby|2 clause bsdl) license"), ("ruby", "ruby is copyrighted free software")],
    "openssl": [("openssl", "redistributions (?:.{0,200} )?openssl toolkit"), ("openssl", "openssl license double license"), ("ssleay", "original ssleay licen[sc]e")],
    "w3c": [("w3c", "w3c software (?:notice|and document notice) and license"), ("w3c", "by obtaining using and or copying this work you (?:.{0,20} )?licensee (?:.{0,80} )?w3c|licensee agree (?:.{0,80} )?w3c")],
    "ofl": [("font", "this font software is licensed under the sil open font license"), ("reserved", "copyright (?:.{0,80} )?with reserved font name"),
            ("font", "neither the font software nor any of its individual components (?:.{0,60} )?may be sold by itself (?:.{0,80} )?licen[a-z]*")],
    "ncsa": [("illinois", "university of illinois ncsa open source license"), ("developed", "neither the names of (?:.{0,80} )?nor the names of its contributors (?:.{0,60} )?without specific prior written permission developed by")],
    "postgresql": [("postgresql", "postgresql database management system (?:.{0,200} )?copyright|portions copyright (?:.{0,60} )?postgresql global development group"),
                   ("written", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted")],
    "vim": [("vim", "distribute unmodified copies of vim (?:.{0,80} )?licen[a-z]*|vim is charityware (?:.{0,120} )?licen[a-z]*")],
    "afl": [("academic", "licensed under the academic free license version [123]"), ("afl", "afl v?[123] [01] licen[sc]e")],
    "osl": [("osl", "licensed under the open software license version [123] (?:.{0,20} )?osl"), ("osl", "osl v?[123] 0 licen[sc]e")],
    "bsl": [("licensor", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
            ("change", "change date (?:.{0,60} )?change license"), ("grant", "additional use grant (?:.{0,80} )?licen[a-z]*|business source license grant")],
    "sspl": [("mongodb", "terms of the server side public license (?:.{0,60} )?as published by mongodb"), ("service", "making the functionality of the program (?:.{0,60} )?available to third parties as a service (?:.{0,120} )?licen[a-z]*")],
    "elastic": [("elastic", "licensed under the elastic license (?:.{0,80} )?except in compliance with"), ("hosted", "you may not provide the software to third parties as a hosted or managed service (?:.{0,200} )?licen[a-z]*")],
    "odbl": [("database", "made available under the open database license"), ("contents", "any rights in individual contents of the database are licensed under")],
    "odc-by": [("odc", "odc by licen[sc]e"), ("commons", "open data commons attribution license")],
    "pddl": [("pddl", "pddl licen[sc]e"), ("commons", "open data commons public domain dedication (?:and )?license")],
    "x11": [("consortium", "except as contained in this notice the name of the x consortium shall not be used (?:.{0,120} )?without prior written (?:authorization|permission) (?:.{0,60} )?copyright"),
            ("x11", "mit x11 licen[sc]e")],
    "curl": [("curl", "copyright (?:.{0,60} )?daniel stenberg (?:.{0,160} )?curl"), ("whether", "curl license whether")],
    "ms-pl": [("microsoft", "microsoft public license (?:.{0,20} )?ms pl"), ("pl", "ms pl licen[sc]e")],
    "ms-rl": [("reciprocal", "microsoft reciprocal licen[sc]e"), ("rl", "ms rl licen[sc]e")],
    "cecill": [("cecill", "governed by the cecill(?: [abc])? licen[sc]e"), ("inria", "circulated by cea cnrs and inria (?:.{0,120} )?licen[a-z]*")],
    "mulan": [("mulan", "licensed under mulan p[su]l ?v?2")],
    "beerware": [("beer", "the beer ware license"), ("beer", "as long as you retain this notice you can do whatever you want (?:.{0,160} )?beer (?:.{0,40} )?licen[a-z]*")],
    "cc0": [("affirmer", "affirmer (?:.{0,80} )?waives (?:.{0,80} )?copyright"), ("waived", "has waived all copyright and related or neighboring rights to this work"),
            ("cc0", "cc0 1 0 universal (?:.{0,20} )?public domain dedication"), ("zero", "creativecommons org (?:licenses|publicdomain) zero 1 0 licen[sc]e")],
    "cc-by": [("creativecommons", "creativecommons org licenses by [1-4] [05]"), ("attribution", "creative commons attribution [1-4] [05] (?:international|generic|unported) licen[sc]e")],
    "cc-by-sa": [("creativecommons", "creativecommons org licenses by sa [1-4] [05]"), ("attribution", "creative commons attribution share ?alike [1-4] [05] (?:international |generic |unported )?licen[sc]e")],
    "cc-by-nc": [("creativecommons", "creativecommons org licenses by nc [1-4] [05]"), ("attribution", "creative commons attribution non ?commercial [1-4] [05] (?:international |generic |unported )?licen[sc]e")],
    "cc-by-nd": [("creativecommons", "creativecommons org licenses by nd [1-4] [05]"), ("attribution", "creative commons attribution no ?deriv(?:ative)?s [1-4] [05] (?:international |generic |unported )?licen[sc]e")],
    "cc-by-nc-sa": [("creativecommons", "creativecommons org licenses by nc sa [1-4] [05]"), ("attribution", "creative commons attribution non ?commercial share ?alike [1-4] [05] (?:international |generic |unported )?licen[sc]e")],
    "cc-by-nc-nd": [("creativecommons", "creativecommons org licenses by nc nd [1-4] [05]"), ("attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s [1-4] [05] (?:international |generic |unported )?licen[sc]e")],
    "public-domain": [("placed", "(?:has been|is|hereby) placed in the public domain"), ("author", "the authors? disclaims? copyright to this source code"),
                      ("copyright", "no copyright is claimed"), ("government", "work of the u(?:nited)? ?s(?:tates)? government (?:.{0,80} )?public domain"), ("pd", "pd licen[sc]e public domain")],
    "qpl": [("q", "q public licen[sc]e"), ("qpl", "qpl licen[sc]e")],
    "nokia": [("nokia", "nokia open source licen[sc]e")], "sleepycat": [("sleepycat", "sleepycat licen[sc]e"), ("sleepycat", "copyright (?:.{0,60} )?sleepycat software")],
    "intel": [("intel", "intel open source licen[sc]e"), ("intel", "intel simplified software licen[sc]e")], "apsl": [("apple", "apple public source licen[sc]e"), ("apsl", "apsl licen[sc]e")],
    "lppl": [("latex", "latex project public licen[sc]e"), ("lppl", "conditions of the lppl version 1 [0-3][a-c]? (?:.{0,40} )?licen[a-z]*"), ("maintained", "this work has the lppl maintenance status maintained (?:.{0,40} )?licen[a-z]*")],
    "naist": [("nara", "nara institute of science and technology (?:.{0,60} )?licen[a-z]*"), ("naist", "naist licen[sc]e")], "upl": [("universal", "universal permissive licen[sc]e")],
    "0bsd": [("zero", "zero clause bsd licen[sc]e"), ("0bsd", "0bsd licen[sc]e"), ("free", "free public license 1 0 0")], "blueoak": [("blue", "blue oak model licen[sc]e")],
    "hippocratic": [("hippocratic", "hippocratic licen[sc]e")], "polyform": [("polyform", "polyform (?:noncommercial|small business|strict|shield|internal use) licen[sc]e")],
    "commons-clause": [("clause", "commons clause licen[sc]e condition"), ("sell", "the license does not grant to you the right to sell the software")],
    "rail": [("openrail", "openrail(?: [ms])? licen[sc]e"), ("bigcode", "bigcode open ?rail m licen[sc]e"), ("creativeml", "creativeml open ?rail m licen[sc]e"),
             ("bigscience", "bigscience (?:bloom )?(?:open ?)?rail licen[sc]e"), ("responsible", "responsible ai licen[sc]e")],
    "jsonlic": [("evil", "the software shall be used for good not evil (?:.{0,60} )?(?:licen[a-z]*|copyright|warrant[a-z]*)|license good not evil")],
    "nvidia": [("nvidia", "nvidia (?:software|source code|open model) licen[sc]e")], "oracle": [("oracle", "oracle (?:binary code|technology network|free use) licen[sc]e")],
    "eula": [("eula", "end user license agreement eula"), ("user", "end user licen[sc]e agreement"), ("reverse", "you may not reverse engineer decompile or disassemble (?:.{0,160} )?licen[a-z]*|license does not permit you to reverse engineer")],
    "proprietary": [("confidential", "confidential and proprietary (?:.{0,80} )?(?:copyright|permission|reserved)"), ("unauthorized", "unauthorized (?:copying|reproduction|use) (?:.{0,80} )?strictly prohibited (?:.{0,60} )?(?:licen[a-z]*|copyright|permission|reserved)"),
                    ("trade", "trade secrets? (?:.{0,80} )?all rights reserved"), ("written", "without the (?:express|prior) written permission of the (?:copyright )?(?:owner|holder|publisher|author)")],
}

# spdx short names, by themselves in a header: label, words of the name
SPDX = [
    ("gpl", "gpl [123] 0 (?:only|or later)"), ("lgpl", "lgpl [23] [01] (?:only|or later)"), ("agpl", "agpl 3 0 (?:only|or later)"), ("apache", "apache [12] [01]"),
    ("bsd", "bsd [234] clause"), ("0bsd", "0bsd"), ("mpl", "mpl [12] [01]"), ("epl", "epl [12] 0"), ("eupl", "eupl 1 [12]"), ("cddl", "cddl 1 [01]"), ("boost", "bsl 1 0"),
    ("ofl", "ofl 1 [01]"), ("artistic", "artistic [12] 0"), ("python", "python 2 0"), ("python", "psf 2 0"), ("bsl", "busl 1 1"), ("elastic", "elastic 2 0"), ("odbl", "odbl 1 0"),
    ("pddl", "pddl 1 0"), ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("mulan", "mulanpsl 2 0"), ("gfdl", "gfdl 1 [123]"), ("upl", "upl 1 0"), ("blueoak", "blueoak 1 0 0"),
    ("cc-by", "cc by [1-4] [05]"), ("cc-by-sa", "cc by sa [1-4] [05]"), ("cc-by-nc", "cc by nc [1-4] [05]"), ("cc-by-nd", "cc by nd [1-4] [05]"), ("cc0", "cc0 1 0"),
    ("qpl", "qpl 1 0"), ("ipl", "ipl 1 0"), ("lppl", "lppl 1 [0-3][ac]?"), ("apsl", "apsl [12] [012]"), ("intel", "intel"), ("nokia", "nokia"), ("naist", "naist 2003"),
    ("sleepycat", "sleepycat"), ("jsonlic", "json"), ("afl", "afl [123] [012]"), ("osl", "osl [123] [01]"), ("sspl", "sspl 1 0"), ("zlib", "zlib acknowledgement"), ("x11", "x11 distribute modifications variant"),
]

# every match of a rule or base phrase holds one of these
GATE = "licen|reserved|public domain|copyright|permission|redistribut|released under|distributed under|available under|granted under|creativecommons|warrant|liable|furnished|without restriction|advertising materials|misrepresented"


def rules() -> list[tuple[str, str, int, float, str]]:
    """All signature rules, best priority first: (label, keyword, priority, confidence, pattern)."""
    out = [(label, key, prio, conf, shape.format(name=name)) for prio, conf, shape in SHAPES for label, name, key in FAMILIES]
    out += [(label, key, 1, 0.90, pattern) for label, some in SIGNATURES.items() for key, pattern in some]
    out += [(label, "spdx", 1, 0.99, f"spdx license identifier {name}") for label, name in SPDX]
    return sorted(out + NOTICES, key=lambda r: r[2])


def _words_in(c: Column) -> Column:
    """Words in a text parted by single blanks, which neither begins nor ends with one."""
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + F.when(c == "", 0).otherwise(1)


def _matches(norm: Column, pattern: Column) -> Column:
    """All matches of ``pattern`` at word borders: array of (start word, end word)."""
    marked = F.split(F.regexp_replace(norm, F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )")), F.lit("\u0001$0\u0002")), F.lit("\u0001"))

    def step(acc: Column, piece: Column) -> Column:
        hit = F.split_part(piece, F.lit("\u0002"), F.lit(1))
        end = acc["at"] + _words_in(hit)
        rest = F.split_part(piece, F.lit("\u0002"), F.lit(2))
        return F.struct((end + F.greatest(_words_in(F.trim(rest)), F.lit(0))).alias("at"),
                        F.concat(acc["hits"], F.array(F.struct(acc["at"].alias("s"), end.alias("e")))).alias("hits"))

    zero = F.struct(_words_in(F.trim(marked[0])).alias("at"), F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("hits"))
    return F.aggregate(F.slice(marked, 2, F.greatest(F.size(marked) - 1, F.lit(1))), zero, step, lambda acc: acc["hits"])


def _detections(norm: Column) -> Column:
    """All detections of all rules: array of (s, back = -end, prio, label, doubt = -conf), of
    which the order is that of ``_resolved``: of equal spans and labels the surest comes first."""
    # a literal pattern is compiled once; only rules that match go on as values
    def hit(rule: tuple[str, str, int, float, str]) -> str:
        label, key, prio, conf, rx = rule
        return (f"CASE WHEN contains(norm, ' {key}') AND regexp_like(norm, r'(?<= )(?:{rx})(?= )') "
                f"THEN struct('{label}' AS label, {prio} AS prio, double({conf}) AS conf, '{rx}' AS rx) END")
    tried = F.array_compact(F.expr("array(" + ", ".join(hit(r) for r in rules()) + ")"))
    return F.flatten(F.transform(tried, lambda r: F.transform(_matches(norm, r["rx"]), lambda m: F.struct(
        m["s"].alias("s"), (-m["e"]).alias("back"), r["prio"].alias("prio"), r["label"].alias("label"), (-r["conf"]).alias("doubt")))))


def _resolved(found: Column) -> Column:
    """Detections without those that one of better priority, or a longer or
    earlier one of the same priority, contains.  In the order of start, then
    longest first, a container comes before what it contains, so the furthest
    end of each priority is all that is needed of what went before."""
    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        best = F.greatest(*[F.when(d["prio"] >= p, acc[f"p{p}"]).otherwise(F.lit(0)) for p in (1, 2, 3)])
        kept = F.when(best >= end, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(F.struct(d["label"].alias("label"), (-d["doubt"]).alias("conf")))))
        return F.struct(*[F.when(d["prio"] == p, F.greatest(acc[f"p{p}"], end)).otherwise(acc[f"p{p}"]).alias(f"p{p}") for p in (1, 2, 3)],
                        kept.alias("kept"))

    zero = F.struct(*[F.lit(0).alias(f"p{p}") for p in (1, 2, 3)], F.expr("cast(array() as array<struct<label:string,conf:double>>)").alias("kept"))
    return F.aggregate(F.array_sort(found), zero, step, lambda acc: acc["kept"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score), one row per row of ``docs``.

    Words are runs of digits, letters (A-Z lower-cased) and all characters beyond ASCII.
    Base: places of the phrases of ``BASE``; first and last are the smallest and
    largest start, counted in words from 0 (null without a place).  ``labels``
    adds the labels of the rules' detections that are left; both lists are
    distinct, sorted, joined by commas ('' if there is none).  ``score``: 1 minus
    the product of (1 - confidence) over the distinct labels found, a base
    label counting 0.9.  Null texts count as empty; ids pass as they are, null
    or repeated; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), lower_ascii(text_col).alias("low"))
    rows = rows.select("doc_id", F.regexp_count("low", F.lit(WORD)).cast("long").alias("n_words"),
                       F.when(F.regexp_like("low", F.lit(GATE.replace(" ", r"[^a-z]+"))), F.col("low")).alias("low"))

    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace("low", GAP, " ")), F.lit(" "))
    rows = rows.select("doc_id", "n_words", norm.alias("norm"))
    def places(phrase: str, label: str) -> Column:
        return F.transform(_matches(F.col("norm"), F.lit(phrase)), lambda m: F.struct(m["s"].alias("s"), F.lit(label).alias("label")))

    base = F.flatten(F.array(*[places(*b) for b in BASE]))
    rows = rows.select("doc_id", "n_words", F.when(F.col("norm").isNotNull(), base).alias("base"),
                       F.when(F.col("norm").isNotNull(), _resolved(_detections(F.col("norm")))).alias("rules"))
    starts = F.transform("base", lambda b: b["s"])
    none = F.array().cast("array<string>")
    base_names = F.coalesce(F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"]))), none)
    names = F.array_sort(F.array_distinct(F.concat(base_names, F.coalesce(F.transform("rules", lambda r: r["label"]), none))))
    rows = rows.select("doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
                       F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
                       base_names.alias("base_names"), names.alias("names"), "rules")
    surest = F.transform("names", lambda n: F.greatest(
        F.when(F.array_contains("base_names", n), F.lit(0.9)).otherwise(F.lit(0.0)),
        F.coalesce(F.array_max(F.transform(F.filter("rules", lambda r: r["label"] == n), lambda r: r["conf"])), F.lit(0.0))))
    score = F.lit(1.0) - F.aggregate(surest, F.lit(1.0), lambda a, c: a * (F.lit(1.0) - c))
    return rows.select("doc_id", "n_words", F.greatest("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                       F.array_join("base_names", ",").alias("base_labels"), F.array_join("names", ",").alias("labels"), score.alias("score"))
