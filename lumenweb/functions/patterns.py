"""Parking patterns by language, and the engine that finds them.

A page is parked if a core word (domain, page, site, or the page's own url) and an attribute (parked, for sale, ...)
stand in one run of the language's characters. Tables can be replaced: ``PatternSet.of`` takes any.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenweb.functions.fixed import LIMITS

# Per language the core words (separated by " & ") and the attributes, one a line:
# expression | notice | indices of cores that it doesn't go with | words that cancel it.
TABLES: dict[str, tuple[str, str]] = {}

TABLES["en"] = (r"( |^)domain & ( |^)page(?!s) & site(?!s)", r"""
parked | p1
owne | p2 | 1 2
sale | p3 | 1 2
(?<!right)(?<!rights) reserved | p4
registered | p5 | 1 2
generated | p6 | 0 2 3 4
registra | p7
unauthorized | p8
expired | p9
available soon | p10
unavailable | p11
not available | p11
available | p12 | 1 2 3 4
create | p13 | 1 2 3 4
coming soon | p14
parking | p15
opening soon | p16
maintenance | p17
maintaining | p18
under development | p19
buy | p20 | 1 2
purchas | p21 | 1 2
suspended | p22
undergoing | p23
censored | p24
blocked | p25
deleted | p26
acquire | p27
establish | p28
display page | p29
taken | p30
not linked | p31
upload | p32
propagated | p33
default | p34
no website here | p35 | 0 1 3 4
cannot be displayed | p36 | 0 2 3 4
construction | p37
""")

TABLES["fr"] = (r"domaine(?!s) & ( |^)page(?!s) & ( |^)site(?!s)", r"""
parking | parked
(?<!droit)(?<!droits) reservé | parked
prochainement | construction
développement | construction
maintenance | construction
redirige pas | construction
moderation | construction
obsolète | expired
expired | expired
supprimé | parked
enregistr | parked | 1 2
aquérir | sale
suspendu | parked
configurez | parked
indisponible | parked
pas disponible | parked
vente | sale
vendre | sale
propriétaire | owner | 1 2
parked | parked
registrar | parked
cré[ée] | parked
construction | construction
domaine | p1 | 0 1 2
déposé | parked
""")

TABLES["es"] = (r"dominio & p[áa]gina(?!s) & ( |^)sitio(?!s)", r"""
pedido | order
venta | sale | 1 2
estacionado | parked
mantenimiento | parked
domaine | parked
disponible | parked
(?<!derecho)(?<!derechos) reserva | parked
compra | sale | 1 2
venta | sale
suspendido | parked
proprietario | parked | 1 2
hosting | parked
alojada | parked
registr | parked | 1 2 3 4
parking | parked
activ[oa] | parked
propagado | parked
defecto | parked
""")

TABLES["zh-cn"] = TABLES["zh-tw"] = (r"域名 & (?<!账号网)站 & 页 & 頁", r"""
购 | sale | 1 2 3
^购买网站$ | sale
在出售 | parked
无法访问 | parked
无法进行访问 | parked
时无法打开 | parked
不可用 | parked
无误 | parked
所有权 | parked | 1 2 3
家主 | sale | 1 2 3
所有者 | sale | 1 2 3
过期 | parked
^网站正在建设中{0,1}$ | construction
施工 | construction
托管 | parked
时发布 | parked
转让 | parked
无对 | parked
没有找到 | parked
中绑定了 | parked
过期 | parked
停放 | parked
""")

TABLES["ru"] = (r"домен & страниц & сайт", r"""
заказать | order
продажа | sale
припарковал | parked
владел | parked | 1 2
хостин | parked
(?<!без )регистра | parked | 1 2
имени | parked
купить | sale | 1 2
конструкт | parked
хостинг | parked
истек | expired
недоступен | parked
прода | sale | 1 2
покуп | sale
зарегистрирова | parked | 1 2 3 4
Создайте | parked
отключен | parked
заблокиров | parked
Перенаправл | parked | 1 2
""")

TABLES["sv"] = (r"( |^)domän( |$|en|namnet|\.) & ( |^)sida( |$|n|\.) & ( |^)hemsida( |$|\.) & ( |^)webbplats( |$|\.) & ( |^)siten( |$|\.)", r"""
ägare | owner
registri*er | registered | 1 2 3
webbhotell | web hosting
uppbyggnad | construction
parker[ai] | parked
konstruktion | construction
äg(s|er) | owned
köp[ae]* | buy
salu | sale | 1 2
hosting | hosting
egna | own
Beställ | buy
underhåll | maintenance
Aktivera | activate | 1 2 3 4 5 6
ladda[ts]* upp | upload
inte (|har )publicera | not published
ingen sida | no page
Denna sida visas | special page | 1 2 3 4 5 6
inte öppnat | not opened
Förfrågan | not opened
Pris | price
""")

TABLES["de"] = (r"( |^)domain( |$|\.) & ( |^)seite( |$|\.) & ( |^)webseite( |$|\.)", r"""
registriert | registered
automatisch erstellt | created automatically | 0
verkauf | sale
kaufen | sale
unkonfiguriert | unconfigured
Aufbau | construction
Inhaber | owner | 1 2 3 4
erreichbar | expired
weitergeleitet | passed
erwerben | purchase
keine Website | no website | 1 2 3 4
geparkt | parked
zugewiesen | assigned | 1 2 3 4
Anschaffung | purchase
Wartungsarbeiten | maintenance
eingestellt | discontinued
""")

TABLES["et"] = (r"( |^)domeen( |$|\.) & ( |^)lehel( |$|\.) & ( |^)veebilehel( |$|\.) & ( |^)veebileht( |$|\.)", r"""
registreeri | registered
Pargitud | parked
ole veel valmis | not ready | 0 4 5
tühjal | empty | 0 4 5
müüki | sale
osta | buy
veel üles seatud | not set up yet
suletud lepingu | expired
registriert | registered
""")

TABLES["it"] = (r"( |^)domini & ( |^)sito( |$|\.) & pagina", r"""
configur[ao] | p1 | 1 2
vend[ui]t[aoi] | p2 | 1 2 | noleggio
acquist[ao] | p3
registr[ao] | p4 | 1 2
disponibil | p5 | | cookie materiali
compra | p6
costruzione | p7
occupato | p8 | 1 2 3 4
manutenzione | p9
propriet[àa] | p10 | 1 2 3 4
aggiornamento | p11 | 0 2
allestimento | p12
attivo | p13 | 1 2 3 4
Hosting | p14 | 1 2 3 4
generata | p15 | 0 1 3 4
cessione | p16
prezzo | p17
presto online | p18 | 0 2 3 4
investire | p19 | 1 2 3 4
trasferimento | p20 | 1 2 3 4
acquire | p21
""")

TABLES["da"] = (r"domæne & websted & ( |^)side( |$|\.)", r"""
Registrer | p1 | 1
registrator | p2
Webhosting | p3 | 1 2 3 4
hoste[dst] | p4 | 1
oprettelse | p5 | 1 2 3 4
webhotel | p6 | 1 2 3 4
parker | p7
ligger | p8 | 1 2 3 4
lukket | p9 | 1 2 3 4
Køb | p10 | 1
ikke e*r* *aktiv | p11
vælge | p12 | 1 2 3 4
salg | p13 | 1 2
inaktiv | p14
konstruktion | p15
o[pm]bygning | p16
ikke t*a*g*e*t* *i brug | p17 | 1 2 3 4
hosting | p18 | 1
pris( |$|\.) | p19 | 1 2 3 4
( |^|\.)ejeren* | p20 | 1 2 3 4
vedligehold | p21 | 0
""")

TABLES["sk"] = (r"( |^)domén[aouy] & stránky", r"""
registr | p1
kúpa | p2
hosting | p3
dostupnos | p4 | 1 2 3
( |^|\.)majit | p5
Exspirované | p6
konštrukcii | p7
parkovaná | p8
vytvort | p9 | 0 2 3
projektom | p10 | 1 2 3
predaj | p11
aktivovaná | p12 | 1
pozastavená | p13
pr[ií]prav | p14 | 0
výstavbe | p15 | 0
hosťovaná | p16
záujem | p16 | 1 2 3
žiaden obsah | p17 | 0
""")

# The characters of a run, by language.
CHARACTERS = {
    "ru": "[a-z '’\"Ѐ-ӿ-]",
    "fr": "[a-z àâäôéèëêïîçùûüÿæœ'’\"-]",
    "zh-cn": "['’\"一-鿿 -]",
    "zh-tw": "['’\"一-鿿 -]",
    "es": "[a-z áéíñóúü'’\"-]",
    "sv": "[a-z äöå'’\"-]",
    "de": "[a-z äöüß'’\"-]",
    "et": "[a-z äöüß'’\"öšž-]",
    "it": "[a-z '’\"àèéìíîòóùú-]",
    "da": "[a-z '’\"æøå-]",
    "sk": "[a-z '’\"áéíĺóŕúýčďľňšťžäô-]",
    "en": "[a-z '’\"-]",
    "other": "[a-z '’\"-]",
}


@dataclass
class Attribute:
    search: re.Pattern
    notice: str
    not_with: frozenset[int] = frozenset()
    cancelled_by: tuple[re.Pattern, ...] = ()


@dataclass
class PatternSet:
    cores: list[re.Pattern]
    attributes: list[Attribute] = field(default_factory=list)

    @classmethod
    def of(cls, cores: str, attributes: str) -> PatternSet:
        out = cls([re.compile(c, re.I) for c in cores.split(" & ")])
        for line in attributes.strip("\n").split("\n"):
            expression, notice, *rest = line.replace(" | | ", " |  | ").split(" | ")
            skip = frozenset(map(int, rest[0].split())) if rest else frozenset()
            cancel = tuple(re.compile(w, re.I) for w in rest[1].split()) if len(rest) > 1 else ()
            out.attributes.append(Attribute(re.compile(expression, re.I), notice, skip, cancel))
        return out


class Runs:
    """A text's runs of one language's characters."""

    def __init__(self, text: str, characters: str):
        self.text = text
        self.breaks = [m.start() for m in re.finditer("[^" + characters[1:], text, re.I)]

    def left(self, at: int) -> int:
        i = bisect.bisect_left(self.breaks, at)
        return self.breaks[i - 1] + 1 if i else 0

    def right(self, at: int) -> int:
        i = bisect.bisect_left(self.breaks, at)
        return self.breaks[i] if i < len(self.breaks) else len(self.text)

    def around(self, core: re.Pattern) -> Iterator[str]:
        """The stretches (run, core, run) that don't overlap; of several cores in the run before one, the last counts."""
        at = 0
        while at <= len(self.text) and (m := core.search(self.text, at)):
            begin, end = max(at, self.left(m.start())), self.right(m.end())
            last = self.right(begin)
            while (more := core.search(self.text, m.start() + 1)) and more.start() <= last:
                m, end = more, self.right(more.end())
            yield self.text[begin:end]
            at = max(end, m.start() + 1)


class PatternEngine:
    def __init__(self, tables: dict[str, tuple[str, str]] | None = None, characters: dict[str, str] | None = None):
        self.sets = {lang: PatternSet.of(*t) for lang, t in (tables or TABLES).items()}
        self.characters = characters or CHARACTERS

    def _search(self, runs: Runs, cores: list[re.Pattern], attributes: list[Attribute], cancel: bool) -> str | None:
        for i, core in enumerate(cores):
            for stretch in runs.around(core):
                for a in attributes:
                    if i not in a.not_with and a.search.search(stretch) and not (cancel and any(w.search(stretch) for w in a.cancelled_by)):
                        return a.notice
        return None

    def detect(self, html: str | None, text: str | None, language: str | None, url: str | None, n_words: int | None) -> tuple[bool, str | None, str | None]:
        """(parked, notice, language without patterns). Pages of many words are passed over, but for Chinese ones."""
        html, text, language, url = html or "", text or "", language or "", url or ""
        if (n_words or 0) >= LIMITS["pattern_words"] and language not in ("zh-cn", "zh-tw"):
            return False, None, None
        scanned = re.sub(" {2,}", ".", html if len(text) <= LIMITS["pattern_text"] else text)
        used = language if language in self.sets else "en"
        missing = None if language in self.sets else language or None
        runs = Runs(scanned, self.characters.get(used, self.characters["other"]))
        own = [re.compile(re.escape(x), re.I) for x in (url, "www." + url)] if url else []
        notice = self._search(runs, self.sets[used].cores + own, self.sets[used].attributes, True)
        if notice is None and used != "en":
            notice = self._search(runs, self.sets["en"].cores, self.sets["en"].attributes, False)
        return notice is not None, notice, missing


_ENGINE: PatternEngine | None = None


def parking_pattern(html: Column, text: Column, language: Column, url: Column, n_words: Column) -> Column:
    """struct(kw_parked, kw_park_notice, missing_language); expressions are compiled once in a worker."""

    @F.pandas_udf("kw_parked boolean, kw_park_notice string, missing_language string")
    def run(html: pd.Series, text: pd.Series, language: pd.Series, url: pd.Series, n_words: pd.Series) -> pd.DataFrame:
        global _ENGINE
        _ENGINE = _ENGINE or PatternEngine()
        rows = [_ENGINE.detect(h, t, g, u, int(n) if n == n and n is not None else 0) for h, t, g, u, n in zip(html, text, language, url, n_words, strict=True)]
        return pd.DataFrame(rows, columns=["kw_parked", "kw_park_notice", "missing_language"])

    # The page itself is only looked at where there is hardly any text.
    page = F.when(F.coalesce(F.length(text), F.lit(0)) <= LIMITS["pattern_text"], html).otherwise("")
    return run(page, text, language, url, n_words.cast("double"))
