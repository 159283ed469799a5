"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

The field adds spans of kinds the patterns don't know (people, identity numbers, local
telephone numbers, secrets); it is trained from the small labelled table below and
decoded by Viterbi in numpy batches.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.llm.common import row_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", "person", "national_id", "local_phone", "secret")
#: Fixed patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only start where a run of digits starts; possessive runs keep long ones linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")

#: The labelled table, all invented: marked stretches are [text|kind]; everything else is O.
LABELLED = (
    "my name is [Anna Keller|person] and i live near the river",
    "please ask [John Smith|person] about the order 48213 today",
    "Name: [Maria Lopez|person] joined in 2019",
    "name: [Peter Osei|person] and others",
    "contact Mr. [Brown|person] before noon",
    "Mrs. [Taylor|person] wrote 3 letters in 1998",
    "Dr. [Elena Petrova|person] sees patients at 10",
    "Ms. [Nguyen|person] and Mr. [Okafor|person] met on 12 May",
    "signed by Prof. [Alan Grey|person] in 2004",
    "Full name: [Carla Bruno Diaz|person]",
    "Mr. [Weber|person] sagt nein",
    "my name is [Luis|person] and this is fine",
    "SSN: [123-45-6789|national_id] on file",
    "her ssn is [987-65-4321|national_id] they said",
    "social security number [219-09-9999|national_id] was given",
    "SSN [078-05-1120|national_id]",
    "passport [X1234567|national_id] expires 2030",
    "Passport no. [C01X00T47|national_id] issued",
    "passport number [L898902C3|national_id] seen",
    "call me at [555-0142|local_phone] after six",
    "phone: [555-123-4567|local_phone] or write",
    "tel. [(212) 555-0199|local_phone] office",
    "Phone [212-555-0147|local_phone] ext 3",
    "mobile: [07700 900123|local_phone] evenings",
    "call [(415) 555-2671|local_phone] today",
    "token = [\"7b1d90ce25fa4863b07e1c9fd25a38e6410c7d9b\"|secret] in the file",
    "token = [\"c29e51f07a8d4b36e1905cfa72d48b03e6f1c95a\"|secret] and more",
    "api_key = [\"sk9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c\"|secret] must not leak",
    "password: [hunter2butlonger99|secret] was set",
    "secret = [\"a8f5f167f44f4964e6c998dee827110c\"|secret] end",
    "token = [\"5e80d3a96c1f47b2908fe6d1c37a5b24f09e81cd\"|secret] es",
    "password = [\"pa55word2024x\"|secret] there",
    "version 2.3.1 came out in 2020 and sold 1,200 copies",
    "the name of the rose was read by 300 people",
    "see page 12-14 and table 3",
    "Licensed under CC BY-NC 4.0. See section 2 for more",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0. See the file",
    "Released under the MIT License, 1988 text and later",
    "Copyright 2021 the authors, all rights reserved under 17 laws",
    "the token ring had 12 nodes in 1995",
    "a key point is that 40 of 100 were red",
    "phone sales rose 12% in 2018 over 2017",
    "call number 7 came first and call 8 second",
    "passport control took 45 minutes",
    "secret gardens opened in 1890 and closed in 1910",
    "from 1914-1918 the town had 10-15 shops",
    "the isbn 978-3-16-148410-0 is printed there",
    "mail bob.7@mail2.example.com or +44 20 7946 0018 now",
    "card 6011000990139424 and host 203.0.113.77 were listed",
    "is the name 5 of them all",
    "the ssn field has 9 digits",
    # Names, telephones and secrets in German, French and Spanish; secrets glued to their key.
    "Herr [Weber|person] wohnt am Markt und Frau [Lindqvist|person] am Hafen",
    "mein Name ist [Jonas Brandt|person] und ich komme aus dem Norden",
    "Frau [Petra Hollmann|person] schrieb gestern einen Brief",
    "Monsieur [Delorme|person] est parti et Madame [Vasseur|person] reste ici",
    "Mme [Claire Aubin|person] habite au bord de la mer",
    "je m'appelle [Hugo Lambert|person] et je viens du sud",
    "Señor [Ibarra|person] llega tarde y Señora [Montes|person] ya se fue",
    "me llamo [Lucía Rojas|person] y vivo en el valle",
    "Nombre: [Tomás Vidal|person] y otros",
    "Passwort: [abendrotimwald|secret] bitte nicht weitergeben",
    "Kennwort: [nebelkrähe77|secret] gilt bis morgen",
    "mot de passe: [soleilcouchant|secret] à ne pas donner",
    "contraseña: [lunallenaenelmar|secret] no se comparte",
    "password: [violetmountain|secret] was set for the box",
    "the line [password=opensesameplease|secret] was left in the file",
    "found [secret=marbleoctopus|secret] in the log",
    "with [token=qz81kd02mx77|secret] and no more",
    "Telefon: [030 5550 118|local_phone] ab neun Uhr",
    "Teléfono: [91 555 02 33|local_phone] por la tarde",
    "Téléphone: [01 55 50 17 42|local_phone] le matin",
    # Plain prose: sentences start with capitals after short words and at line ends.
    "It was so. Rain fell on the hills. They left. The boat was gone. Nobody asked.",
    "We sat in it. Others stood. Then came the news. Spring was late. Ice held on.",
    "He said no. Winter came. Birds flew on. Fields lay bare. Snow fell.",
    "Of this and that. Morning light. Is it in. Evening came to us. Rivers rose in it.",
    "As it is. With them. From there on. That was by us. This is it. Where to.",
    "An old mill. Wind and Water. Stone Bridges of the North. In the Hills. A. Better Way.",
    "Weather. Harvest\nMarket days\nRoads and rivers. Letters from home. On it. Dust.",
    "Es war gut. Regen fiel auf die Stadt. Dann kam der Abend. Kinder liefen heim. Und so.",
    "Der Fluss trat über die Ufer. Felder und Wiesen. Das Haus am Wald. Von da an. Nichts blieb.",
    "La nuit tombe. Le vent du nord. Il est là. Personne ne vient. Eux et la mer. Des Ponts.",
    "El sol se pone. Nadie vino. Es la hora. Los Campos del Sur. Que no. Después llovió.",
    "the name of it. Rivers have a name. Call it home. Secret paths. Tokens of love. Phone lines fell.",
    "Herr und Knecht gingen fort. Frau und Kind. Sein Name war vergessen. Der Name. Ohne Namen.",
    "El nombre del río. Señor de nadie. Le nom de la rose. Madame est servie. Un mot de plus.",
    "Passwort: [sonne|secret] und mehr",
    "Passwort: [wolkenbruch|secret] dann weiter",
    "password: [tigers|secret] and more",
    "uncharacteristically the counterrevolutionaries and internationalization of misunderstandings went on",
    "donaudampfschifffahrt und lebensversicherung mit geschwindigkeitsbegrenzung. bundesausbildung der rindfleischetikettierung",
    "anticonstitutionnellement et extraordinairement pour des incompréhensibilités dans la rematérialisation",
    "electroencefalografista y desafortunadamente con otorrinolaringólogo de internacionalización, por",
    "Der Grundstücksverkehrsgenehmigung. Straßenbahn. Öfen. Übermut der. Ärger. Fähre mit. Größe",
    # Headlines, lists, notices and quoted speech: capitals, marks and numbers without any name, number or secret of a person.
    "Contents. Preface. Maps. Part One. Origins. Trade. War. Part Two. Peace. Index. Notes.",
    "Breaking News: Storm Warning For Coast. Schools Closed. Trains Late. Power Out In 40 Streets.",
    "SPECIAL OFFER!!! BUY NOW!!! ONLY 5 LEFT!!! FREE SHIPPING*** TODAY ONLY*** CALL NOW!!!",
    "*** Clearance *** Shoes $20, Coats $45, Hats $9. Open Daily. No Refunds. ### 10% off ###",
    "Ingredients: Flour, Butter, Sugar. Method: Mix. Bake. Cool. Serve. Time: 45 minutes.",
    "Monday. Tuesday. Wednesday.\nMorning. Noon.\nEvening. Night.\nHome | News | Sport | Weather | Help",
    "Go. Stop. Wait. Who is it? It is me. Come in. Sit down. Tea or coffee? Coffee. Good.",
    "Figure 3. Results. Table 12. Costs by Year. Source: Census. Note: Rounded. See Appendix B.",
    "Oak. Ash. Elm. Birch.\nGold. Silver. Iron. Tin.\nNorth. South. East. West. Up and Down.",
    "Act I. Scene 2. Enter Soldiers. Exit Ghost. Thunder. Curtain. The End.",
    "Old Town Hall. New Bridge. Long Lane. Mill Pond. High Street. Market Square at Dusk.",
    "Inhalt. Vorwort. Karten. Erster Teil. Anfang und Ende. Zweiter Teil. Krieg. Frieden. Anhang. Quellen.",
    "Regen am Morgen. Sonne am Mittag. Wind und Wolken. Im Norden Schnee. Aussichten: Heiter. Höchstwerte um 20 Grad.",
    "Zutaten: Mehl, Butter, Zucker. Zubereitung. Rühren. Backen. Abkühlen.\nÄpfel. Birnen. Nüsse. Öl. Essig.",
    "Achtung!!! Nur heute!!! Alles muss raus*** Schuhe, Mäntel, Hüte*** Über 100 Angebote. Größe und Farbe. Maß.",
    "Freiheit. Gleichheit. Gerechtigkeit und Wirklichkeit. Zeitung von der Werkstatt. Haltung. Übung macht.",
    "Sommaire. Préface. Première Partie. Les Origines. La Guerre. Seconde Partie. La Paix. Annexes. Été. Hiver.",
    "Attention!!! Offre du jour*** Manteaux, Chapeaux, Gâteaux. Ouvert le Dimanche. À bientôt. Être ou ne pas être.",
    "Météo. Pluie le matin. Éclaircies. Vent du Nord.\nRecettes. Œufs. Beurre. Sucre. Mélanger. Cuire. Servir.",
    "Eau. Feu. Terre. Air. Bateaux et châteaux. Les Oiseaux. Aux bords de la mer. Ils étaient là. Des Roseaux.",
    "Índice. Prólogo. Primera Parte. Los Orígenes. La Guerra. Segunda Parte. La Paz. Notas. Árboles. Última hora.",
    "Oferta!!! Solo hoy!!! Zapatos, Abrigos, Sombreros*** Abierto. Cerrado. Entrada. Salida. Precio: 20 euros.",
    "Tiempo. Lluvia por la mañana. Viento del Norte.\nRecetas. Huevos. Aceite. Mezclar. Servir. Ñoquis. Éxito.",
    "Verdad. Realmente. Ciudad y universidad. Los Mares. Ellos cantaban. Del puerto. Con el tiempo. Mente sana.",
    "Card number 4242424242424242 was refused. Server 192.0.2.14 is down. Write to desk@shop.example today.",
    "Call +49 30 901820 or +33 1 40 20 50 50 for tickets. Fax +34 91 330 28 00. Hours: 9 to 17.",
    "time: now and place: here or so:called things and left=right in sums",
)

#: Words whose presence is a feature; fixed values.
CUES = frozenset("name mr mrs ms dr prof ssn social security passport phone tel mobile call token api_key password secret key is number no = : herr frau ist monsieur madame mme m'appelle señor señora llamo nombre nom passwort kennwort passe contraseña clave telefon teléfono téléphone".split())
BITS = 11
#: Words whose emissions are held at once; a longer text goes alone.
CHUNK = 1 << 15
#: A key and its value in one word.
_GLUED = re.compile(r"(\w+)[=:]+.")
_EDGE = "\"'.,;:!?*#$%&|"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that pass its test; a failing match is dropped, not retried."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


class _Classes(dict):
    """Code point -> its class, for ``str.translate``."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = out = "X" if c.isupper() else "x" if c.islower() else "d" if c.isdigit() else c
        return out


_CLASSES = _Classes()
_RUNS = re.compile(r"([xX])\1\1+|d{5,}")


def shape(word: str) -> str:
    """Letters and digits by class, with runs of one class cut to their length's bucket."""
    kinds = word.strip(_EDGE).translate(_CLASSES)
    return _RUNS.sub(lambda m: f"{m[0][0]}+" if len(m[0]) < 12 else f"{m[0][0]}*", kinds)


@lru_cache(maxsize=1 << 15)
def _hashed(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) % (1 << BITS)


def word_features(word: str) -> tuple[int, int, int, int]:
    """Hashed features: shape, mix of classes with length bucket, cue word (alone or glued to a value), edges."""
    core = word.strip(_EDGE).lower()
    plain = word.isalpha()
    letters, digits = (True, False) if plain else (any(c.isalpha() for c in word), any(c.isdigit() for c in word))
    mix = f"{letters:d}{digits:d}{word[:1].isupper():d}{min(len(core) // 8, 3)}"
    cue = core if core in CUES else word if word in CUES else "-"
    if cue == "-" and not plain and (m := _GLUED.match(core)) and m[1] in CUES:
        cue = m[1] + "+"
    edges = "--" if plain or word[:1].isalnum() and word[-1:].isalnum() else word[:1] + word[-1:]
    return _hashed("s", shape(word)), _hashed("m", mix), _hashed("c", cue), _hashed("e", edges)


class _Words(dict):
    """Word -> number of its row in the features and in the emission tables; row 0 stands for no word."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self):
        super().clear()
        self.fresh, self.tables, self.weights = [], None, None

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self) + 1
        self.fresh.append(word_features(word))
        return row

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """(offset, row, label) scores of all words met so far."""
        if self.weights is None:
            self.weights, self.rows = weights, 1
            self.tables = np.zeros((len(weights), 1 << 12, weights.shape[2]))
        assert self.weights is weights
        if self.fresh:
            end = self.rows + len(self.fresh)
            if end > self.tables.shape[1]:
                grown = np.zeros((len(weights), 2 * end, weights.shape[2]))
                grown[:, : self.rows] = self.tables[:, : self.rows]
                self.tables = grown
            self.tables[:, self.rows : end] = weights[:, np.array(self.fresh)].sum(axis=2)
            self.rows, self.fresh = end, []
        return self.tables


def _emissions(weights: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """(n, labels) scores of a stretch: each word's own features and its neighbours'."""
    own = weights[:, feats].sum(axis=2)  # offset, word, label
    out = own[2].copy()
    for k, off in ((0, 2), (1, 1), (3, -1)):
        if off > 0:
            out[off:] += own[k][:-off]
        else:
            out[:off] += own[k][-off:]
    return out


def viterbi(emissions: list[np.ndarray], trans: np.ndarray, batch: int = 512) -> list[np.ndarray]:
    """Best labels of every stretch; stretches of like length step together."""
    out: list = [None] * len(emissions)
    order = sorted(range(len(emissions)), key=lambda i: len(emissions[i]))
    lo = 0
    while lo < len(order):
        # A long stretch isn't put with short ones, which would be padded to its length.
        most = max(16, 2 * len(emissions[order[lo]]))
        some = [i for i in order[lo : lo + batch] if len(emissions[i]) <= most]
        lo += len(some)
        size = len(emissions[some[-1]])
        e = np.zeros((len(some), size, trans.shape[0]))
        n = np.array([len(emissions[i]) for i in some])
        for r, i in enumerate(some):
            e[r, : n[r]] = emissions[i]
        best, back = e[:, 0], np.zeros(e.shape, np.int16)
        for t in range(1, size):
            via = best[:, :, None] + trans
            back[:, t] = via.argmax(axis=1)
            best = np.where((t < n)[:, None], via.max(axis=1) + e[:, t], best)
        label = best.argmax(axis=1)
        path = np.zeros((len(some), size), np.int16)
        for t in range(size - 1, -1, -1):
            path[:, t] = label
            label = np.where(t < n, back[np.arange(len(some)), t, label], label) if t else label
        for r, i in enumerate(some):
            out[i] = path[r, : n[r]]
    return out


def parse_labelled(line: str) -> tuple[list[str], list[int]]:
    words, labels = [], []
    for part in re.split(r"(\[[^\]|]+\|\w+\])", line):
        m = re.fullmatch(r"\[([^\]|]+)\|(\w+)\]", part)
        got = (m[1] if m else part).split()
        words += got
        labels += [LABELS.index(m[2]) if m else 0] * len(got)
    return words, labels


@lru_cache(maxsize=1)
def train_field(steps: int = 250, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights[offset, feature, label], transitions) by gradient steps on the log-likelihood of LABELLED."""
    rows = [parse_labelled(x) for x in LABELLED]
    feats = [np.array([word_features(w) for w in words]) for words, _ in rows]
    k = len(LABELS)
    w, trans = np.zeros((4, 1 << BITS, k)), np.zeros((k, k))
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)

    def lse(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        gw, gt = -decay * w, -decay * trans
        for f, (_, y) in zip(feats, rows, strict=True):
            e, n = _emissions(w, f), len(y)
            a, b = np.zeros((n, k)), np.zeros((n, k))
            a[0] = e[0]
            for t in range(1, n):
                a[t] = e[t] + lse(a[t - 1][:, None] + trans, 0)
            for t in range(n - 2, -1, -1):
                b[t] = lse(trans + e[t + 1] + b[t + 1], 1)
            z = lse(a[-1], 0)
            g = -np.exp(a + b - z)
            g[np.arange(n), y] += 1
            for t in range(1, n):
                gt -= np.exp(a[t - 1][:, None] + trans + e[t] + b[t] - z)
                gt[y[t - 1], y[t]] += 1
            for o, off in ((0, 2), (1, 1), (2, 0), (3, -1)):
                src = slice(0, n - off) if off >= 0 else slice(-off, n)
                dst = slice(off, n) if off >= 0 else slice(0, n + off)
                for j in range(f.shape[1]):
                    np.add.at(gw[o], f[src, j], g[dst])
        for p, g, m, v in ((w, gw, mw, vw), (trans, gt, mt, vt)):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w, trans


def certain_gain(trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most that the transitions into and out of a word give each other label over O: [0] whatever the next word there has, [1] where that has O or is none."""
    into, out_of = trans - trans[:, :1], (trans - trans[:1]).T
    return tuple(np.maximum([g.max(axis=0)[1:], g[0, 1:]], 0) + 1e-9 for g in (into, out_of))


def decode(rows: list[np.ndarray], tables: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labels of all words end to end, with two places around texts; where each text starts).

    The best path of each whole text: every word is scored.  Where O leads by more than any
    transitions can make up for, O is on every best path; a path through a fixed label is
    best when its two sides are, so what lies between such words is decoded by itself.
    """
    gap = np.zeros(2, np.int64)
    ids = np.concatenate([gap, *(x for r in rows for x in (r, gap))])
    e = tables[2][ids]
    e[2:] += tables[0][ids[:-2]]
    e[1:] += tables[1][ids[:-1]]
    e[:-1] += tables[3][ids[1:]]
    is_word = ids > 0
    lead = e[:, :1] - e[:, 1:]
    into, out_of = certain_gain(trans)
    unsure = (lead <= into[0] + out_of[0]).any(axis=1) & is_word
    for _ in range(2):  # with the words now known to be O on either side, more are
        at = np.flatnonzero(unsure)
        near = lead[at] <= into[(~unsure[at - 1]).astype(np.int8)] + out_of[(~unsure[at + 1]).astype(np.int8)]
        unsure[at] = near.any(axis=1)
    cuts = np.flatnonzero(np.diff(unsure, prepend=False, append=False))
    first, end = cuts[::2], cuts[1::2]
    follows = first[is_word[first - 1]]
    leads = end[is_word[end]] - 1
    e[follows] += trans[0]
    e[leads] += trans[:, 0]
    labels = np.zeros(len(ids), np.int16)
    paths = viterbi([e[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)], trans)
    if paths:
        labels[unsure] = np.concatenate(paths)
    return labels, np.cumsum([2, *(len(r) + 2 for r in rows)])[:-1]


def field_spans(texts: list[str], model: tuple[np.ndarray, np.ndarray], cache: _Words) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) that the field finds in each text; every word of every text is decoded."""
    weights, trans = model
    out: list[list] = [[] for _ in texts]
    held: list = []
    size = 0
    for i, text in enumerate(texts):
        words = text.split()
        held.append((i, np.fromiter(map(cache.__getitem__, words), np.int64, len(words))))
        size += len(words)
        if size < CHUNK and i + 1 < len(texts):
            continue
        labels, starts = decode([r for _, r in held], cache.emissions(weights), trans)
        cuts = np.flatnonzero(np.diff(labels, prepend=0, append=0))
        lo, hi = cuts[:-1], cuts[1:]
        found = labels[lo] > 0
        lo, hi = lo[found], hi[found]
        owner = np.searchsorted(starts, lo, "right") - 1
        at: dict[int, list] = {}
        for k, a, b in zip(owner.tolist(), lo.tolist(), hi.tolist(), strict=True):
            j = held[k][0]
            if j not in at:
                at = {j: [m.span() for m in re.finditer(r"\S+", texts[j])]}
            start, end = at[j][a - starts[k]][0], at[j][b - 1 - starts[k]][1]
            while start < end and texts[j][start] in _EDGE:
                start += 1
            while start < end and texts[j][end - 1] in _EDGE:
                end -= 1
            if start < end:
                out[j].append((LABELS[labels[a]], start, end))
        held, size = [], 0
    return out


def find_spans(texts: list[str], model, cache: _Words) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text: base ones stay, the field's are added where they touch none."""
    base = [base_spans(t) for t in texts]
    out = []
    for b, more in zip(base, field_spans(texts, model, cache), strict=True):
        free = [s for s in more if all(s[2] <= x[1] or s[1] >= x[2] for x in b)]
        out.append((b, b + sorted(free, key=lambda s: (LABELS.index(s[0]), s[1]))))
    return out


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are masked as one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


SPANS = "spans array<struct<kind:string,start:int,`end`:int,base:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def detect(docs: DataFrame, keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the ``keep`` columns, spans, masked text for every row.

    Offsets count code points, ends are exclusive.  Null texts count as empty (no spans,
    masked ''); repeated rows give repeated results; very long texts are decoded whole; an empty table
    gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_field())  # under 1 MB
    src = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col).cast("long").alias("doc_id"), *keep)

    def find(batches):
        cache = _Words()
        for b in row_slices(batches):
            if len(cache) > 100_000:
                cache.clear()
            texts = [t or "" for t in b.column(0).to_pylist()]
            both = find_spans(texts, model.value, cache)
            rows = [[{"kind": k, "start": s, "end": e, "base": i < len(base)} for i, (k, s, e) in enumerate(all_)] for base, all_ in both]
            masked = [mask(t, all_) for t, (_, all_) in zip(texts, both, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(rows, _SPAN), pa.array(masked, pa.string())], names=[*b.schema.names[1:], "spans", "masked"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:])
    return src.mapInArrow(find, f"{kinds}, {SPANS}, masked string")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, their sha256 digest and the list of all spans."""
    text = lambda only: F.concat_ws(",", F.transform(F.filter("spans", only), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(lambda s: s["base"]), 256).alias("base_sha256"), text(lambda s: F.lit(True)).alias("spans"))


def spans_digest(base: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
