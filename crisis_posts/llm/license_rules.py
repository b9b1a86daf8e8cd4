"""The signatures of licenses, written by hand over normalized words, and the forms they come in.

A text is matched as its lower-case words with one space between them, so ``CC BY-SA 4.0`` reads
``cc by sa 4 0``; characters beyond ASCII are written as the bytes of their UTF-8. Each license
lists its identifiers, names, addresses and sentences of its text, and every form that these come
in is a signature. The parts of a signature that are neither optional nor a choice are its
keywords: a text that lacks one of them need not be searched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_LICENSE = "licen[sc]e"
_VERSION = "(?:v|version )?"

# label, identifiers, names, addresses, sentences
LICENSES = (
    ("mit", ("mit", "expat"),
     (f"mit {_LICENSE}", f"mit style {_LICENSE}", f"mit x11 {_LICENSE}", f"expat {_LICENSE}"),
     ("opensource org licenses mit(?: license)?(?: php| html)?", "mit license org"),
     ("permission is hereby granted free of charge to any person obtaining a copy of this software",)),
    ("mit-0", ("mit 0",), ("mit no attribution(?: license)?",), (), ()),
    ("apache-1.1", ("apache 1 1",),
     (f"apache software {_LICENSE} {_VERSION}1 1", f"apache {_LICENSE} {_VERSION}1 1"), (), ()),
    ("apache-2.0", ("apache 2(?: 0)?", "asl 2 0"),
     (f"apache(?: software)? {_LICENSE} {_VERSION}2(?: 0)?", f"apache 2(?: 0)? {_LICENSE}"),
     ("apache org licenses license 2 0(?: txt| html)?", "opensource org licenses apache 2 0"),
     ("irrevocable copyright license to reproduce prepare derivative works of",)),
    ("apache", ("apache",), (f"apache(?: software)? {_LICENSE}",),
     ("apache org licenses",), ()),
    ("bsd-2-clause", ("bsd 2 clause",),
     (f"2 clause bsd {_LICENSE}", f"two clause bsd {_LICENSE}", f"simplified bsd {_LICENSE}", f"freebsd {_LICENSE}"),
     ("opensource org licenses bsd 2 clause",), ()),
    ("bsd-3-clause",
     ("bsd 3 clause",),
     (f"3 clause bsd {_LICENSE}", f"three clause bsd {_LICENSE}", f"new bsd {_LICENSE}",
      f"modified bsd {_LICENSE}", f"revised bsd {_LICENSE}"),
     ("opensource org licenses bsd 3 clause",),
     ("may be used to endorse or promote products derived from this software without specific prior written permission",)),
    ("bsd-4-clause", ("bsd 4 clause",),
     (f"4 clause bsd {_LICENSE}", f"four clause bsd {_LICENSE}", f"original bsd {_LICENSE}"), (),
     ("all advertising materials mentioning features or use of this software must display",)),
    ("0bsd", ("0bsd",), (f"zero clause bsd(?: {_LICENSE})?",),
     ("opensource org licenses 0bsd",), ()),
    ("bsd", ("bsd",),
     (f"bsd {_LICENSE}", f"bsd style {_LICENSE}"), ("opensource org licenses bsd license(?: php)?",),
     ("redistribution and use in source and binary forms with or without modification are permitted",)),
    ("isc", ("isc",), (f"isc {_LICENSE}",),
     ("opensource org licenses isc(?: license)?",),
     ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",)),
    ("zlib", ("zlib",), (f"zlib(?: libpng)? {_LICENSE}",), ("opensource org licenses zlib(?: license)?",), ()),
    ("libpng", ("libpng",), (f"libpng {_LICENSE}",), (), ()),
    ("bsl-1.0", ("bsl 1 0",), (f"boost software {_LICENSE}(?: {_VERSION}1 0)?", f"boost {_LICENSE}"),
     ("boost org license 1 0(?: txt)?",), ()),
    ("gpl-1.0", ("gpl 1 0(?: only| or later)?", "gplv1"),
     (f"general public {_LICENSE} {_VERSION}1(?: 0)?", "gpl (?:v|version )1(?: 0)?"), ("gnu org licenses gpl 1 0",), ()),
    ("gpl-2.0", ("gpl 2 0(?: only)?", "gplv2", "gpl v2"),
     (f"general public {_LICENSE} {_VERSION}2(?: 0)?", "gpl (?:v|version )2(?: 0)?", "gpl 2(?: 0)?"),
     ("gnu org licenses (?:old licenses )?gpl 2 0", "opensource org licenses gpl 2 0"), ()),
    ("gpl-2.0+", ("gpl 2 0 or later", "gplv2 or later"),
     (f"general public {_LICENSE} {_VERSION}2(?: 0)? or (?:any )?later(?: version)?",
      "gpl (?:v|version )?2(?: 0)? or (?:any )?later(?: version)?"), (),
     (f"general public {_LICENSE} as published by the free software foundation either version 2",)),
    ("gpl-3.0", ("gpl 3 0(?: only)?", "gplv3", "gpl v3"),
     (f"general public {_LICENSE} {_VERSION}3(?: 0)?", "gpl (?:v|version )3(?: 0)?", "gpl 3(?: 0)?"),
     ("gnu org licenses gpl 3 0", "opensource org licenses gpl 3 0"), ()),
    ("gpl-3.0+", ("gpl 3 0 or later", "gplv3 or later"),
     (f"general public {_LICENSE} {_VERSION}3(?: 0)? or (?:any )?later(?: version)?",
      "gpl (?:v|version )?3(?: 0)? or (?:any )?later(?: version)?"), (),
     (f"general public {_LICENSE} as published by the free software foundation either version 3",)),
    ("lgpl-2.0", ("lgpl 2 0(?: only| or later)?",),
     (f"library general public {_LICENSE} {_VERSION}2(?: 0)?", f"library general public {_LICENSE}"),
     ("gnu org licenses (?:old licenses )?lgpl 2 0",), ()),
    ("lgpl-2.1", ("lgpl 2 1(?: only| or later)?", "lgplv2 1"),
     (f"lesser general public {_LICENSE} {_VERSION}2 1", "lgpl (?:v|version )?2 1"),
     ("gnu org licenses (?:old licenses )?lgpl 2 1",), ()),
    ("lgpl-3.0", ("lgpl 3 0(?: only| or later)?", "lgplv3"),
     (f"lesser general public {_LICENSE} {_VERSION}3(?: 0)?", "lgpl (?:v|version )?3(?: 0)?"),
     ("gnu org licenses lgpl 3 0",), ()),
    ("lgpl", ("lgpl",), (f"lesser general public {_LICENSE}",),
     ("gnu org licenses lgpl",), ()),
    ("agpl-3.0", ("agpl 3 0(?: only| or later)?", "agplv3"),
     (f"affero general public {_LICENSE} {_VERSION}3(?: 0)?", "agpl (?:v|version )?3(?: 0)?"),
     ("gnu org licenses agpl 3 0",), ()),
    ("agpl", ("agpl",), (f"affero general public {_LICENSE}",), ("gnu org licenses agpl",), ()),
    ("gpl", ("gpl",),
     (f"gnu general public {_LICENSE}", f"gnu gpl(?: {_LICENSE})?", f"gpl {_LICENSE}"), ("gnu org licenses gpl",), ()),
    ("gfdl-1.1", ("gfdl 1 1(?: only| or later)?",), (f"gnu free documentation license {_VERSION}1 1",), (), ()),
    ("gfdl-1.2", ("gfdl 1 2(?: only| or later)?",), (f"gnu free documentation license {_VERSION}1 2",), (), ()),
    ("gfdl-1.3", ("gfdl 1 3(?: only| or later)?",),
     (f"gnu free documentation license {_VERSION}1 3",), ("gnu org licenses fdl 1 3",), ()),
    ("gfdl", ("gfdl",), ("gnu free documentation license",), (), ()),
    ("mpl-1.1", ("mpl 1 1",), (f"mozilla public {_LICENSE} {_VERSION}1 1",), ("mozilla org mpl mpl 1 1",), ()),
    ("mpl-2.0", ("mpl 2 0",),
     (f"mozilla public {_LICENSE} {_VERSION}2(?: 0)?", f"mozilla public {_LICENSE} {_VERSION}2 0"),
     ("mozilla org mpl 2 0", "mozilla org en us mpl 2 0"), ("this source code form is subject to the terms of the mozilla public license",)),
    ("mpl", ("mpl",), (f"mozilla public {_LICENSE}",), ("mozilla org mpl",), ()),
    ("epl-1.0", ("epl 1 0",), (f"eclipse public {_LICENSE} {_VERSION}1 0",), ("eclipse org legal epl v10(?: html)?",), ()),
    ("epl-2.0", ("epl 2 0",), (f"eclipse public {_LICENSE} {_VERSION}2 0",), ("eclipse org legal epl 2 0", "eclipse org legal epl v20(?: html)?"), ()),
    ("epl", ("epl",), (f"eclipse public {_LICENSE}",), ("eclipse org legal epl",), ()),
    ("edl-1.0", (), (f"eclipse distribution {_LICENSE}(?: {_VERSION}1 0)?",), ("eclipse org org documents edl v10(?: php| html)?",), ()),
    ("cddl-1.0", ("cddl 1 0",), (f"common development and distribution {_LICENSE}(?: cddl)?(?: {_VERSION}1 0)?",), ("opensource org licenses cddl1(?: php)?",), ()),
    ("cddl-1.1", ("cddl 1 1",), (f"common development and distribution {_LICENSE}(?: cddl)? {_VERSION}1 1",), (), ()),
    ("cpl-1.0", ("cpl 1 0",), (f"common public {_LICENSE}(?: {_VERSION}1 0)?",), (), ()),
    ("eupl-1.1", ("eupl 1 1",), (f"european union public {_LICENSE} {_VERSION}1 1",), (), ()),
    ("eupl-1.2", ("eupl 1 2",), (f"european union public {_LICENSE} {_VERSION}1 2",), (), ()),
    ("eupl", ("eupl",), (f"european union public {_LICENSE}",), (), ()),
    ("cecill-2.1", ("cecill 2 1",), (f"cecill(?: free software)? {_LICENSE}(?: agreement)?(?: {_VERSION}2 1)?",), ("cecill info",), ()),
    ("cecill-b", ("cecill b",), (f"cecill b(?: free software)? {_LICENSE}",), (), ()),
    ("cecill-c", ("cecill c",), (f"cecill c(?: free software)? {_LICENSE}",), (), ()),
    ("artistic-1.0", ("artistic 1 0(?: perl)?",), (f"artistic {_LICENSE} {_VERSION}1 0",), (), ()),
    ("artistic-2.0", ("artistic 2 0",), (f"artistic {_LICENSE} {_VERSION}2 0",), ("opensource org licenses artistic (?:license )?2 0",), ()),
    ("artistic", ("artistic",), (f"artistic {_LICENSE}",), (), ()),
    ("psf-2.0", ("psf 2 0", "psf", "python 2 0"), (f"python software foundation {_LICENSE}(?: {_VERSION}2)?", f"psf {_LICENSE}(?: agreement)?"), (), ()),
    ("ruby", ("ruby",), (f"ruby {_LICENSE}", f"ruby s {_LICENSE}"), (), ()),
    ("php-3.01", ("php 3 01",), (f"php {_LICENSE} {_VERSION}3 01",), ("php net license 3 01 txt",), ()),
    ("php", ("php 3 0",), (f"php {_LICENSE}",), (), ()),
    ("w3c", ("w3c",), (f"w3c software(?: notice and)? {_LICENSE}", f"w3c {_LICENSE}"), (), ()),
    ("unlicense", ("unlicense",), ("unlicense license", "the unlicense"), ("unlicense org",),
     ("free and unencumbered software released into the public domain",)),
    ("wtfpl", ("wtfpl",), (f"do what the fuck you want to public {_LICENSE}",), ("wtfpl net",), ()),
    ("ncsa", ("ncsa",), (f"ncsa open source {_LICENSE}", f"university of illinois ncsa open source {_LICENSE}"), (), ()),
    ("openssl", ("openssl",), (f"openssl {_LICENSE}",), (), ()),
    ("ofl-1.1", ("ofl 1 1",), (f"sil open font {_LICENSE}(?: {_VERSION}1 1)?", f"open font {_LICENSE}"), ("scripts sil org ofl",), ()),
    ("afl-3.0", ("afl 3 0",), (f"academic free {_LICENSE}(?: {_VERSION}3 0)?",), (), ()),
    ("osl-3.0", ("osl 3 0",), (f"open software license(?: {_VERSION}3 0)?",), (), ()),
    ("ms-pl", ("ms pl",), (f"microsoft public {_LICENSE}(?: ms pl)?",), (), ()),
    ("ms-rl", ("ms rl",), (f"microsoft reciprocal {_LICENSE}(?: ms rl)?",), (), ()),
    ("upl-1.0", ("upl 1 0",), (f"universal permissive {_LICENSE}(?: {_VERSION}1 0)?",), (), ()),
    ("ecl-2.0", ("ecl 2 0",), (f"educational community {_LICENSE}(?: {_VERSION}2 0)?",), (), ()),
    ("postgresql", ("postgresql",), (f"postgresql {_LICENSE}",), ("opensource org licenses postgresql",), ()),
    ("mulanpsl-2.0", ("mulanpsl 2 0",), (f"mulan permissive software {_LICENSE} {_VERSION}2", f"mulan psl {_VERSION}2"), (), ()),
    ("busl-1.1", ("busl 1 1",), (f"business source {_LICENSE}(?: {_VERSION}1 1)?",), (), ()),
    ("sspl-1.0", ("sspl 1 0",), (f"server side public {_LICENSE}(?: {_VERSION}1(?: 0)?)?",), (), ()),
    ("elastic-2.0", ("elastic 2 0",), (f"elastic {_LICENSE}(?: {_VERSION}2 0)?",), ("elastic co licensing elastic license",), ()),
    ("odbl-1.0", ("odbl(?: 1 0)?",), (f"open database {_LICENSE}(?: {_VERSION}1 0)?", f"open data commons open database {_LICENSE}"), ("opendatacommons org licenses odbl",), ()),
    ("odc-by-1.0", ("odc by(?: 1 0)?",), ("open data commons attribution license",), ("opendatacommons org licenses by",), ()),
    ("pddl-1.0", ("pddl(?: 1 0)?",), ("public domain dedication and license",), ("opendatacommons org licenses pddl",), ()),
    ("cc0-1.0", ("cc0(?: 1 0)?", "cc zero"), ("creative commons cc0", "cc0 1 0 universal"), ("creativecommons org publicdomain zero 1 0",), ()),
    ("cc-pdm-1.0", (), ("public domain mark(?: 1 0)?",), ("creativecommons org publicdomain mark 1 0",), ()),
    ("openrail", ("openrail", "openrail m", "bigscience openrail m", "creativeml openrail m"), (f"open responsible ai {_LICENSE}", f"responsible ai {_LICENSE}", "creativeml open rail m"), (), ()),
    ("llama", ("llama2", "llama3"), (f"llama (?:2 |3 )?community {_LICENSE}",), (), ()),
    ("ogl-uk-3.0", ("ogl uk 3 0",), (f"open government {_LICENSE} {_VERSION}3 0",), ("nationalarchives gov uk doc open government licence version 3",), ()),
    ("ogl", ("ogl uk",), (f"open government {_LICENSE}",), ("nationalarchives gov uk doc open government licence",), ()),
)

# The clauses of the attribution licenses: suffix of the label, words, names; and their versions.
_CLAUSES = (
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
)
_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0", "")


def _attribution_licenses() -> tuple:
    """cc-by-sa-4.0 and so on: each clause with each version, and with none."""
    out = []
    for suffix, words, names in _CLAUSES:
        for version in _VERSIONS:
            label = f"cc-{suffix}" + (f"-{version}" if version else "")
            number = " " + version.replace(".", " ") if version else ""
            address = f"creativecommons org licenses {words}{number}"
            out.append((
                label, (f"cc {words}{number}",),
                (f"creative commons {names}{number and '(?: v)?'}{number}(?: (?:international|unported|generic))?(?: {_LICENSE})?",
                 f"cc {words}{number} {_LICENSE}"),
                (address,), (),
            ))
    return tuple(out)


# Signatures that stand alone: label, pattern, confidence.
NOTICES = (
    ("reserved", "all rights reserved", 0.6),
    ("reserved", "alle rechte vorbehalten", 0.6),
    ("reserved", "tous droits r\xc3\xa9serv\xc3\xa9s", 0.6),
    ("reserved", "todos los derechos reservados", 0.6),
    ("copyright", "copyright (?:c )?(?:\xc2\xa9 )?(?:19|20)[0-9]{2}", 0.4),
    ("copyright", "copyright c", 0.3),
    ("public-domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 0.7),
    ("public-domain", "public domain", 0.4),
    ("proprietary", "proprietary and confidential", 0.7),
    ("proprietary", f"proprietary {_LICENSE}", 0.6),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited", 0.9),
    ("non-commercial", "(?:for )?non commercial (?:use|purposes) only", 0.6),
    ("creative-commons", f"creative commons {_LICENSE}", 0.5),
)

# The phrases whose places are counted, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

_UNDER = (
    " (?:under|by|with|through) (?:a |the )?(?:terms (?:and conditions )?of )?(?:a |the )?(?:gnu )?"
)
_GRANTS = ("licen[sc]ed", "(?:released|distributed|available|published|provided|covered|shared)")


@dataclass(frozen=True)
class Rule:
    """A signature. Priority 0 is the highest; of equal ones the earlier rule wins."""

    label: str
    form: str
    priority: int
    confidence: float
    pattern: str

    def compiled(self) -> re.Pattern:
        return re.compile(f"(?<= ){self.pattern}(?= )")

    def keywords(self) -> frozenset[str]:
        """Pieces of three characters or more that every match holds."""
        left, group = self.pattern, r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\??"
        for part in (group, r"\[[^\]]*\](?:\{\d+\})?\??", r".\?"):
            left = re.sub(part, "\0", left)
        return frozenset(piece for piece in left.split("\0") if len(piece) >= 3)


def _rules() -> tuple[Rule, ...]:
    out = []
    for label, ids, names, addresses, sentences in (*LICENSES, *_attribution_licenses()):
        forms = (
            ("tag", 0, 1.0, [f"spdx license identifier {i}" for i in ids]),
            ("text", 1, 1.0, sentences),
            ("address", 2, 0.95, addresses),
            ("grant", 3, 0.9, [grant + _UNDER + x for grant in _GRANTS for x in (*names, *ids)]),
            ("field", 4, 0.8, [f"{_LICENSE} (?:name |type |id )?{i}" for i in ids]),
            ("name", 5, 0.7, names),
        )
        out += [Rule(label, form, p, c, x) for form, p, c, patterns in forms for x in patterns]
    out += [Rule(label, "notice", 6, c, x) for label, x, c in NOTICES]
    out += [Rule(label, "phrase", 7, 0.5, phrase) for phrase, label in BASE]
    return tuple(out)


RULES = _rules()
