"""Licence detection by ordered signature rules; built-in expressions only.

A text is lower-cased (A-Z), cut into words and joined by single spaces. Rules are regexes over that form, each with a
keyword or several, a label and a priority (smaller is stronger). Every match of a rule holds one of its keywords, so
rows without any keyword are done after a substring search.
For others only rules with a keyword that is present run, all their matches become word intervals, and overlaps are
resolved: from the strongest match on (priority, then length, so that of two of one priority the containing one wins),
each goes that overlaps one that stays. Plain phrases are places of their own that nothing suppresses.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartolith.llm.lines import pinned

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Rule:
    keyword: str  # or several, with | between: any one of them activates the rule
    label: str
    priority: int
    pattern: str
    gate: str = ""  # a substring that texts with a match have; the longest word of each keyword where empty

    @property
    def keywords(self) -> list[str]:
        return self.keyword.split("|")

    @property
    def needs(self) -> set[str]:
        return {self.gate} if self.gate else {max(k.split(" "), key=len) for k in self.keywords}


#: Label, keyword, how the licence is called (regex over words), its SPDX id as words.
FAMILIES = (
    ("mit", "mit|expat", "mit|expat", "mit"),
    ("mit-0", "mit", "mit no attribution|mit 0", "mit 0"),
    ("apache-2.0", "apache", "apache(?: software)? license,? (?:version |v )?2(?: 0)?|apache 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)? license (?:version |v )?1 1", "apache 1 1"),
    ("gpl-3.0", "general public", "(?<!lesser )(?<!affero )(?:gnu )?general public license (?:version |v )?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-2.0", "general public", "(?<!lesser )(?<!affero )(?:gnu )?general public license (?:version |v )?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-1.0", "general public", "(?<!lesser )(?<!affero )(?:gnu )?general public license (?:version |v )?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public license (?:version |v )?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license (?:version |v )?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.0", "library general", "(?:gnu )?library general public license (?:version |v )?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license(?: (?:version |v )?3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", "free documentation", "(?:gnu )?free documentation license(?: version 1 3)?", "gfdl 1 3(?: only| or later)?"),
    ("bsd-2-clause", "bsd", "bsd 2 clause|2 clause bsd|simplified bsd|freebsd", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "bsd 4 clause|4 clause bsd|original bsd", "bsd 4 clause"),
    ("0bsd", "bsd", "bsd zero clause|zero clause bsd", "0bsd"),
    ("isc", "isc", "isc", "isc"),
    ("mpl-2.0", "mozilla", "mozilla public license(?: (?:version |v )?2(?: 0)?)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla", "mozilla public license (?:version |v )?1 1", "mpl 1 1"),
    ("epl-2.0", "eclipse", "eclipse public license(?: (?:version |v )?2(?: 0)?)?", "epl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public license (?:version |v )?1(?: 0)?", "epl 1 0"),
    ("edl-1.0", "eclipse", "eclipse distribution license(?: (?:version |v )?1(?: 0)?)?", "edl 1 0"),
    ("cddl-1.0", "common development", "common development and distribution license(?: (?:version )?1(?: 0)?)?", "cddl 1 0"),
    ("cpl-1.0", "common public", "common public license(?: (?:version )?1(?: 0)?)?", "cpl 1 0"),
    ("eupl-1.2", "european union", "european union public licence(?: (?:version |v )?1 2)?", "eupl 1 2"),
    ("artistic-2.0", "artistic", "artistic license(?: (?:version )?2(?: 0)?)?", "artistic 2 0"),
    ("artistic-1.0", "artistic", "artistic license (?:version )?1(?: 0)?", "artistic 1 0"),
    ("bsl-1.0", "boost", "boost software license(?: (?:version )?1(?: 0)?)?", "bsl 1 0"),
    ("busl-1.1", "business source", "business source license(?: (?:version )?1 1)?", "busl 1 1"),
    ("sspl-1.0", "server side", "server side public license(?: (?:version |v )?1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic license(?: (?:version |v )?2(?: 0)?)?", "elastic 2 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl|fuck you want", "wtfpl|do what the fuck you want to public license", "wtfpl"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("libpng", "libpng", "libpng", "libpng(?: 2 0)?"),
    ("psf-2.0", "python|psf", "python software foundation license(?: (?:version )?2)?|psf license", "psf 2 0"),
    ("postgresql", "postgresql", "postgresql license", "postgresql"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("php-3.01", "php", "php license(?: version 3 01)?", "php 3 01"),
    ("ofl-1.1", "open font", "(?:sil )?open font license(?: (?:version )?1 1)?", "ofl 1 1"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("odbl-1.0", "open database", "open database license(?: (?:version |v )?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by", "attribution license", "open data commons attribution license(?: (?:version |v )?1(?: 0)?)?", "odc by 1 0"),
    ("pddl-1.0", "public domain dedication", "(?:open data commons )?public domain dedication and license", "pddl 1 0"),
    ("cc0-1.0", "cc0|creative commons zero", "cc0(?: 1 0)?(?: universal)?|creative commons zero", "cc0 1 0"),
    ("cc-by", "cc by", "cc by(?: [1-4] [05])?", "cc by [1-4] [05]"),
    ("cc-by-sa", "cc by", "cc by sa(?: [1-4] [05])?", "cc by sa [1-4] [05]"),
    ("cc-by-nc", "cc by", "cc by nc(?: [1-4] [05])?", "cc by nc [1-4] [05]"),
    ("cc-by-nd", "cc by", "cc by nd(?: [1-4] [05])?", "cc by nd [1-4] [05]"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1-4] [05])?", "cc by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1-4] [05])?", "cc by nc nd [1-4] [05]"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?", "cc by"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?", "cc by sa"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?", "cc by nc"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?derivatives(?: [1-4] [05])?", "cc by nd"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?", "cc by nc sa"),
    ("vim", "vim", "vim license", "vim"),
    ("beerware", "beer", "beer ?ware license", "beerware"),
    ("upl-1.0", "universal permissive", "universal permissive license(?: (?:version |v )?1(?: 0)?)?", "upl 1 0"),
)

#: Fixed values, written by hand from the licences' own texts and usual notices: keyword, label, pattern over words.
SENTENCES = (
    # MIT and its kin
    ("permission is hereby granted", "mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("without restriction", "mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge"),
    ("permission notice shall", "mit", "(?:the )?above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("authors or copyright holders", "mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("express or implied including", "mit", "the software is provided as is without warranty of any kind express or implied including but not limited to"),
    ("person or organization", "bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("machine executable object", "bsl-1.0", "solely in the form of machine executable object code generated by a source language processor"),
    ("good not evil", "json", "the software shall be used for good not evil"),
    ("permission to use", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("disclaims all warranties", "isc", "the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("written agreement", "postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("in all copies", "hpnd", "is hereby granted provided that the above copyright notice appears? in all copies"),
    ("advertising or publicity", "hpnd", "not be used in advertising or publicity pertaining to distribution of the software without specific"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license"),
    # BSD
    ("redistribution and use", "bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("redistributions of source", "bsd", "redistributions of source code must retain the above copyright notice"),
    ("redistributions in binary", "bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("neither the name", "bsd-3-clause", "neither the name of (?:the )?[^ ]+(?: [^ ]+){0,6} nor the names of its contributors"),
    ("endorse or promote", "bsd-3-clause", "may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("all advertising materials", "bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("copyright holders and contributors", "bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("the regents", "bsd", "this software is provided by the regents and contributors as is"),
    ("exemplary or consequential", "bsd", "liable for any direct indirect incidental special exemplary or consequential damages"),
    # Apache
    ("without warranties or conditions", "apache-2.0", "without warranties or conditions of any kind either express or implied"),
    ("in compliance with the license", "apache-2.0", "you may not use this file except in compliance with the license"),
    ("distributed on an as is basis", "apache-2.0", "software distributed under the license is distributed on an as is basis without warranties"),
    ("contributor hereby grants", "apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("contributor license agreements", "apache-2.0", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("carry prominent notices", "apache-2.0", "you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("developed by the apache", "apache-1.1", "this product includes software developed by the apache software foundation"),
    ("apache license", "apache-1.0", "apache license version 1 0"),
    # GNU
    ("free software", "gpl", "this program is free software you can redistribute it and or modify"),
    ("without even the implied", "gpl", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("copy of the gnu general", "gpl", "you should have received a copy of the gnu general public license"),
    ("verbatim copies", "gnu", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("take away your freedom", "gpl", "the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change"),
    ("either version 2", "gpl-2.0-or-later", "either version 2 of the license or at your option any later version"),
    ("either version 3", "gpl-3.0-or-later", "either version 3 of the license or at your option any later version"),
    ("version 2 only", "gpl-2.0-only", "general public license version 2 only"),
    ("version 3 only", "gpl-3.0-only", "general public license version 3 only"),
    ("this library is free software", "lgpl", "this library is free software you can redistribute it and or modify"),
    ("copy of the gnu lesser", "lgpl", "you should have received a copy of the gnu lesser general public license"),
    ("copy of the gnu library", "lgpl-2.0", "you should have received a copy of the gnu library general public license"),
    ("derivative of any portion", "lgpl-2.1", "a program that contains no derivative of any portion of the library but is designed to work with the library"),
    ("combined work", "lgpl-3.0", "a combined work is a work produced by combining or linking an application with the library"),
    ("copy of the gnu affero", "agpl", "you should have received a copy of the gnu affero general public license"),
    ("remote network interaction", "agpl-3.0", "remote network interaction use with the gnu general public license"),
    ("interacting with it remotely", "agpl-3.0", "all users interacting with it remotely through a computer network"),
    ("special exception", "gpl-exception", "as a special exception (?:the copyright holders of this library give you permission|if other files instantiate templates)"),
    ("classpath exception|linking exception|library exception", "gpl-exception", "(?:classpath|linking|runtime library) exception"),
    ("modify this document", "gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("invariant sections", "gfdl", "with no invariant sections no front cover texts and no back cover texts"),
    # Mozilla, Eclipse and other weak copyleft
    ("source code form", "mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("copy of the mpl", "mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("incompatible with secondary", "mpl-2.0", "this source code form is incompatible with secondary licenses"),
    ("contents of this file", "mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("netscape public", "npl-1.1", "netscape public license(?: version 1 [01])?"),
    ("accompanying materials", "epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("accompanying program", "epl", "the accompanying program is provided under the terms of this eclipse public license"),
    ("accompanying program", "cpl-1.0", "the accompanying program is provided under the terms of this common public license"),
    ("contents of this file", "cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("ibm public", "ipl-1.0", "ibm public license(?: version 1 0)?"),
    ("eupl", "eupl", "licensed under the eupl"),
    ("cecill", "cecill", "(?:the )?cecill(?: b| c)? licen[cs]e"),
    ("same terms as perl", "perl", "under the same terms as perl(?: itself)?"),
    ("may be copied", "artistic", "the intent of this document is to state the conditions under which a package may be copied"),
    ("latex project", "lppl", "(?:conditions of the )?latex project public license"),
    ("q public", "qpl", "the q public license"),
    ("academic free", "afl", "academic free license(?: version [123] [0-9])?"),
    ("open software license", "osl", "open software license(?: version [123] [0-9])?"),
    # zlib, public domain, fonts, data
    ("held liable", "zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("misrepresented", "zlib", "the origin of this software must not be misrepresented"),
    ("plainly marked", "zlib", "altered source versions must be plainly marked as such"),
    ("free and unencumbered", "unlicense", "this is free and unencumbered software released into the public domain"),
    ("anyone is free", "unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("neighboring rights", "cc0-1.0", "waived all copyright and related or neighboring rights"),
    ("associated a work", "cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("released into the public domain", "public-domain", "(?:is|are|been) released into the public domain"),
    ("public domain", "public-domain", "(?:dedicated to|placed in|in) the public domain"),
    ("no known copyright", "public-domain", "no known copyright restrictions"),
    ("no rights reserved", "public-domain", "no rights reserved"),
    ("united states government", "public-domain", "(?:is a )?work of the united states government"),
    ("font software", "ofl-1.1", "this font software is licensed under the sil open font license"),
    ("designs of glyphs", "ofl-1.1", "may be modified altered or added to and in particular the designs of glyphs"),
    ("database is made available", "odbl-1.0", "this database is made available under the open database license"),
    ("individual contents", "dbcl-1.0", "any rights in individual contents of the database are licensed under the database contents license"),
    ("do what the fuck", "wtfpl", "you just do what the fuck you want to"),
    ("retain this notice", "beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    # Creative Commons deeds
    ("licensed under a creative", "cc", "this (?:work|article|content) is licensed under a creative commons"),
    ("redistribute the material", "cc", "copy and redistribute the material in any medium or format"),
    ("appropriate credit", "cc-by", "you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made"),
    ("commercial purposes", "cc-by-nc", "you may not use the material for commercial purposes"),
    ("under the same license as", "cc-by-sa", "you must distribute your contributions under the same license as the original"),
    ("distribute the modified", "cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material"),
    # projects with a text of their own
    ("psf hereby grants", "psf-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl toolkit", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("php software", "php-3.01", "this product includes php software freely available from"),
    ("ruby", "ruby", "under the same terms as ruby|ruby s licen[cs]e"),
    ("imagemagick", "imagemagick", "imagemagick licen[cs]e"),
    ("curl", "curl", "curl licen[cs]e"),
    ("unicode", "unicode-dfs", "unicode (?:inc )?license agreement data files and software"),
    ("grants you a non exclusive", "ms-pl", "each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution"),
    # source available
    ("third parties as a service", "sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("non production use", "busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("hosted or managed service", "elastic-2.0", "you may not provide the software to third parties as a hosted or managed service"),
    ("commons clause", "commons-clause", "commons clause(?: license condition)?"),
    ("polyform", "polyform", "polyform (?:noncommercial|small business|shield|strict|internal use|free trial) license"),
    ("llama", "llama-community", "llama [234](?: [0-9])? community licen[cs]e(?: agreement)?"),
    ("openrail|open rail", "openrail", "(?:bigscience |creativeml )?open ?rail(?: m| s)?(?: license)?"),
    # restrictions
    ("commercial use only", "non-commercial", "(?:for )?non ?commercial use only"),
    ("evaluation", "evaluation-only", "for evaluation purposes only|evaluation license"),
    ("all rights reserved", "proprietary", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential|confidential and proprietary|proprietary license"),
    ("proprietary information", "proprietary", "this software is the (?:confidential and )?proprietary information of"),
    ("strictly prohibited", "proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution|duplication) of this (?:file|software|material|document|work) (?:via any medium )?is strictly prohibited"),
    ("may be reproduced", "proprietary", "no part of this (?:publication|book|document|work|material|page) may be reproduced"),
    ("written permission", "proprietary", "(?:without|except with) (?:the )?(?:prior )?(?:express )?written permission of (?:the )?(?:publisher|author|copyright (?:holder|owner))"),
    ("written consent", "proprietary", "without (?:the )?(?:prior )?(?:express )?written consent"),
    ("property of", "proprietary", "licensed materials property of"),
    ("end user licen", "eula", "end user licen[cs]e agreement"),
    ("trade secret", "proprietary", "contains trade secrets?"),
    # notices
    ("spdx license identifier", "spdx-other", "spdx license identifier [^ ]+"),
    ("dual licen", "dual-license", "dual licen[cs]ed under"),
    ("dual licen", "dual-license", "dual licen[cs]e"),
    ("licen", "see-license", "see (?:the )?(?:accompanying )?licen[cs]e(?: txt| md)? file"),
    ("for details|for more details", "see-license", "see (?:the )?(?:[^ ]+ ){0,4}licen[cs]e for (?:more )?details"),
    ("warrant", "warranty-disclaimer", "provided as is without (?:any )?(?:express or implied )?warrant(?:y|ies)"),
    ("no warranty", "warranty-disclaimer", "there is no warranty for the program|comes with absolutely no warranty"),
    ("absolutely no warranty", "warranty-disclaimer", "comes with absolutely no warranty"),
    ("your own risk", "warranty-disclaimer", "use (?:it |this software |them )?at your own risk"),
    ("copyright", "copyright-notice", "copyright (?:c |© )?(?:19|20)[0-9]{2}"),
    ("©", "copyright-notice", "© (?:19|20)[0-9]{2}"),
    ("copyrighted", "copyright-notice", "this (?:work|material|document|content) is copyrighted"),
    ("copyright holder", "copyright-notice", "the copyright holders? (?:is|are|of)"),
)
#: Substrings one of which most sentences have, the rarer first: the first search of a text looks for these, and an
#: everyday word among them would let most texts through.
GATES = (
    "licens", "copyright", "redistribut", "warrant", "permission", "permit", "prohibited", "public domain", "liable", "unencumbered", "perpetual", "invariant", "misrepresented", "plainly", "fuck", "whatever", "evil",
    "hereby", "sublicense", "endorse", "publicity", "derivative", "combined", "remotely", "trademark", "intent", "glyphs", "remix", "indicate", "openssl", "proprietary", "confidential", "reproduced", "reserved", "consent", "risk", "affero", "incompatible", "limitation", "distributed", "compile", "functionality", "hosted", "perl", "php", "apache", "licen",
)

#: Keywords that are everyday words; for these families a rule must also say licence.
EVERYDAY = ("mit", "bsd", "isc", "eclipse", "artistic", "boost", "elastic", "vim", "beer", "python", "php", "cc by", "microsoft", "zlib", "libpng", "openssl", "postgresql", "open font")

#: Priority, how sure a match is, and the frame around a family's name or id.
FRAMES = (
    (1, 1.0, "id", "spdx license identifier (?:{})"),
    (2, 0.95, "name", "licen[cs]ed (?:under|by) (?:the )?(?:terms of )?(?:the )?(?:{})(?: licen[cs]e)?"),
    (3, 0.9, "name", "(?:released|distributed|available|published|provided|covered|governed|subject to|see|read|under) (?:under |by )?(?:the )?(?:terms of )?(?:the )?(?:{})(?: licen[cs]e)?"),
    (4, 0.85, "name", "licen[cs]e (?:is )?(?:the )?(?:{})"),
    (5, 0.8, "name", "(?:{})(?: licen[cs]e)"),
)
SURE = {**{p: s for p, s, *_ in FRAMES}, 6: 0.7, 7: 0.5}
BASE_SCORE = 0.6


def rules() -> list[Rule]:
    """Every family in every frame, names that say licence themselves alone, and the sentences: 490 rules or so."""
    out = []
    for label, keyword, name, spdx in FAMILIES:
        everyday = any(k in EVERYDAY for k in keyword.split("|"))
        for p, _, kind, frame in FRAMES:
            pattern = frame.format(name if kind == "name" else spdx)
            if kind == "id":
                out.append(Rule("spdx", label, p, pattern))
            elif everyday:
                out.append(Rule(keyword, label, p, pattern + " licen[cs]e" if p == 3 else pattern, "licen"))
            else:
                out.append(Rule(keyword, label, p, pattern))
        if not everyday and re.search("licen[cs]e|creative", name):
            out.append(Rule(keyword, label, 6, name))
    return out + [Rule(k, label, 7, p, next((g for g in GATES if g in _fixed(p)), "")) for k, label, p in SENTENCES]


def _fixed(pattern: str) -> str:
    """What every match of a pattern holds: its parts outside of groups, classes and optional letters, line by line."""
    while (shorter := re.sub(r"\(\?:[^()]*\)\??", "\n", pattern)) != pattern:
        pattern = shorter
    return "" if "|" in pattern else re.sub(r"\[[^]]*\][?+]?|.\?", "\n", pattern)


def _literal(rs: list[Rule]) -> Column:
    edge = lambda p: rf"(?<![^ ])(?:{p})(?![^ ])"
    return F.array(*(F.struct(F.array(*map(F.lit, r.keywords)).alias("keywords"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(edge(r.pattern)).alias("pattern")) for r in rs))


BLOCK = 1024


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def none_of(x: Column) -> Column:
    """An empty array of x's type."""
    return F.slice(F.array(x), 1, 0)


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states after each element, as array: a fold that keeps them. In blocks, so that long arrays stay linear."""

    def one(state: Column, x: Column) -> Column:
        return let(step(state["s"], x), lambda s: F.struct(s.alias("s"), F.concat(state["out"], F.array(s)).alias("out")))

    def block(state: Column, xs: Column) -> Column:
        own = F.aggregate(xs, F.struct(state["s"].alias("s"), none_of(state["s"]).alias("out")), one)
        return let(own, lambda o: F.struct(o["s"].alias("s"), F.concat(state["out"], F.array(o["out"])).alias("out")))

    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    blocks = F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(values, k * BLOCK + 1, BLOCK))).otherwise(none_of(values))
    return F.flatten(F.aggregate(blocks, F.struct(zero.alias("s"), none_of(none_of(zero)).alias("out")), block, lambda state: state["out"]))


def _places(words: Column, pattern: Column) -> Column:
    """All matches of pattern as array of struct(first, last) in words."""
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    # how many words on a match ends, and how many more than one it has
    both = lambda hits: F.zip_with(F.slice(F.split(words, pattern, -1), F.lit(1), F.size(hits)), hits, lambda g, h: F.struct((spaces(g) + spaces(h)).alias("far"), spaces(h).alias("wide")))
    ends = lambda parts: running(F.transform(parts, lambda p: p["far"]), F.lit(0), lambda at, far: at + far)
    places = lambda parts: F.zip_with(parts, ends(parts), lambda p, end: F.struct((end - p["wide"]).alias("first"), end.alias("last")))
    return let(F.regexp_extract_all(words, pattern, F.lit(0)), lambda hits: let(both(hits), places))


def word_count(text: Column) -> Column:
    """Words of a text: parts between separators, less an empty one at either end."""
    sep = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    begins, ends = (text == "") | F.left(text, F.lit(1)).rlike(sep), F.right(text, F.lit(1)).rlike(sep)
    return F.size(F.split(text, sep + "+", -1)) - begins.cast("int") - ends.cast("int")


def _phrase(words: Column, phrase: str, label: str) -> Column:
    """All places of a phrase as array of struct(first, label)."""
    at = _places(words, F.lit(rf"(?<![^ ])(?:{phrase})(?![^ ])"))
    return F.when(F.contains(words, F.lit(phrase)), F.transform(at, lambda x: F.struct(x["first"].alias("first"), F.lit(label).alias("label")))).otherwise(F.expr("cast(array() as array<struct<first:int,label:string>>)"))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases: tuple = PHRASES, signature_rules: list[Rule] | None = None) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections for every row's whole text.

    detections: array of struct(first, last, priority, label), in word places from 0, after suppression. score is the
    strongest surviving rule's certainty (0 without any). Null and empty texts have no words. Every row stands for itself,
    also those that share an id. Matches of equal rank keep the order of their starts, then of their labels.
    """
    rs = rules() if signature_rules is None else signature_rules
    keywords = sorted({k for r in rs for k in r.keywords})
    gates = sorted(set().union(*(r.needs for r in rs)) | {max(p.split(" "), key=len) for p, _ in phrases})
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    low = pinned(d, "low", F.lower("t"))
    gate = F.lit(False)
    for g in gates:
        gate = gate | F.contains("low", F.lit(g))
    d = low.select("id", word_count(F.col("t")).cast("long").alias("n_words"), F.when(gate, F.col("t")).alias("t"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    d = pinned(d, "words", F.array_join(F.regexp_extract_all(F.translate("t", upper, lower), F.lit(f"({WORD})"), F.lit(1)), " ")).drop("t")
    d = pinned(d, "present", F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.col("words"), k)))
    d = pinned(d, "active", F.filter(_literal(rs), lambda r: F.arrays_overlap("present", r["keywords"])))
    found = F.transform("active", lambda r: F.transform(_places(F.col("words"), r["pattern"]), lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), r["priority"].alias("priority"), r["label"].alias("label"))))
    d = pinned(d, "found", F.array_sort(F.flatten(found)))
    d = pinned(d, "base", F.flatten(F.array(*(_phrase(F.col("words"), p, label) for p, label in phrases))))
    d = _with_survivors(d)
    none = F.array().cast("array<string>")
    base_labels = F.array_sort(F.array_distinct(F.coalesce(F.transform("base", lambda x: x["label"]), none)))
    labels = F.array_sort(F.array_distinct(F.concat(base_labels, F.coalesce(F.transform("alive", lambda x: x["label"]), none))))
    sure = F.create_map(*(F.lit(v) for kv in SURE.items() for v in kv))
    best = F.coalesce(F.array_max(F.transform("alive", lambda x: F.element_at(sure, x["priority"]))), F.lit(0.0))
    size = F.coalesce(F.size("base"), F.lit(0))
    return d.select(
        F.col("id").alias(id_col),
        "n_words",
        F.greatest(size, F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["first"])).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(best, F.when(size > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
        F.col("alive").alias("detections"),
    )


def _with_survivors(d: DataFrame) -> DataFrame:
    """d with `alive`: its `found` (sorted by first) without what overlaps a stronger match that stays.

    Stronger is the smaller priority, then the longer match, then the earlier one, then the smaller label. Matches are
    settled from the strongest on, against those that stay only. Groups that do not overlap are settled apart.
    """
    found = F.col("found")
    group = running(found, F.struct(F.lit(-1).alias("reach"), F.lit(-1).alias("group")), lambda s, d: F.struct(F.greatest(s["reach"], d["last"]).alias("reach"), (s["group"] + (d["first"] > s["reach"]).cast("int")).alias("group")))
    d = pinned(d, "groups", F.transform(group, lambda g: g["group"]))
    d = pinned(d, "begins", F.array_compact(F.transform("groups", lambda g, i: F.when((i == 0) | (g != F.get("groups", i - 1)), i))))
    ends = F.concat(F.slice("begins", 2, F.greatest(F.size("begins") - 1, F.lit(0))), F.array(F.size("groups")))
    d = pinned(d, "settled", F.flatten(F.zip_with("begins", F.slice(ends, 1, F.size("begins")), lambda a, b: let(F.slice("found", a + 1, b - a), _settle))))
    return pinned(d, "alive", F.array_sort(F.transform("settled", lambda x: F.struct(x["first"], x["last"], x["priority"], x["label"]))))


def _settle(group: Column) -> Column:
    """The matches of one group (sorted by first) that stay.

    Rank by rank, of one priority and length each: matches over words that are taken go, of the others each that begins
    behind the last one stays. What is taken is an array with a place for each word of the group, so that the time is
    in proportion to the group for each rank, also in long chains of overlaps.
    """
    base = F.get(group, F.lit(0))["first"]
    span = F.array_max(F.transform(group, lambda d: d["last"])) - base + 1
    long = lambda d: d["last"] - d["first"] + 1
    rank = lambda d: F.struct(d["priority"].alias("priority"), (-long(d)).alias("short"))

    def settle_rank(state: Column, r: Column) -> Column:
        taken = state["taken"]
        free = F.filter(group, lambda d: (d["priority"] == r["priority"]) & (-long(d) == r["short"]) & ~F.array_contains(F.slice(taken, d["first"] - base + 1, long(d)), 1))
        step = lambda s, d: F.when(d["first"] > s["end"], F.struct(d["last"].alias("end"), F.lit(True).alias("stays"))).otherwise(F.struct(s["end"].alias("end"), F.lit(False).alias("stays")))
        flags = lambda f: running(f, F.struct((base - 1).alias("end"), F.lit(False).alias("stays")), step)
        chosen = lambda f: let(flags(f), lambda g: F.filter(f, lambda d, i: F.get(g, i)["stays"]))
        before = lambda c, i: F.when(i > 0, F.get(c, i - 1)["last"]).otherwise(base - 1)
        marks = lambda c: F.flatten(F.transform(c, lambda d, i: F.concat(F.array_repeat(F.lit(0), d["first"] - before(c, i) - 1), F.array_repeat(F.lit(1), long(d)))))
        merged = lambda c: F.zip_with(taken, marks(c), lambda x, y: F.greatest(x, F.coalesce(y, F.lit(0))))
        return let(let(free, chosen), lambda c: F.struct(merged(c).alias("taken"), F.concat(state["kept"], c).alias("kept")))

    zero = F.struct(F.array_repeat(F.lit(0), span).alias("taken"), F.slice(group, 1, 0).alias("kept"))
    settled = F.aggregate(F.array_sort(F.array_distinct(F.transform(group, rank))), zero, settle_rank, lambda state: state["kept"])
    return F.when(F.size(group) == 1, group).otherwise(settled)
