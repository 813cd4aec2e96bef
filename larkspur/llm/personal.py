"""Problem 2: personal information in free text, found and replaced by typed placeholders.

Generators with high recall propose overlapping spans (email addresses, phone numbers, identity numbers, street addresses, names of persons), each for one kind.
A name is proposed by its form (two capitalised words, with an initial or particles between them), after a title or a word that introduces people, or by a common
given name; none of these is needed. Boosted trees, one set a kind, judge every candidate by its format (digits, groups, signs, check digits, case) and context
(words before and after it); calibrated probabilities over a kind's threshold are accepted, the likeliest first, overlapping ones falling out. Thresholds are those
with the best F1 on scores of texts the trees have not seen.

The trees are trained on texts generated from number formats, common phrases and random words for names, streets and places, so nothing of the corpus is needed
for training, and results don't depend on its size.

Defined cases: null texts have no items and stay null; empty texts have none; repeated rows get equal results; positions count code points of the text as
it stands, whatever invisible characters it has; texts of any length are searched whole.
"""

from __future__ import annotations

import functools
import random
import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.boosting import Calibrated
from larkspur.llm.chars import changes, latin_table, plain_table

KINDS = ("email", "phone", "id_number", "address", "name")

# Common given names of several languages, without accents.
GIVEN = frozenset(
    """ada adam adele adriana agnes alain albert alberto alejandro alex alexander alice alicia amelia ana andrea andreas angela anita anna anne antoine antonio arthur barbara beatriz ben bernard
    bianca boris bruno camille carla carlos carmen caroline catarina cecilia celine charles charlotte chiara christian clara claire claudia clement cristina daniel david diana diego dieter dora
    eduardo elena elisa elizabeth ella elsa emilia emily emma enzo eric ernst eva fabio federico felipe felix fernando filipa florence francesca francesco francois frank frida gabriel giorgio giovanni giulia
    greta guido gustav hannah hans heinrich helena helga henry hugo ida igor ines ingrid irene isabel ivan jack jakob james jan jean jens joana joao john jonas jorge jose juan julia julien karin karl
    katharina klaus laura lea leo leonie lena linda lisa louis louise luca lucas lucia luigi luis luisa manuel marc marco margarita maria marie mario marta martin mary matteo max michael miguel
    nadia natalia nicolas nina olga oliver oscar pablo paola patrick paul paula pedro peter petra philippe pierre rafael rosa ruth sara silvia simon sofia sophie stefan susanne teresa thomas tomas ursula victor vera""".split()
)
# Function words, and common verbs and adverbs beside names, that are no part of a name.
COMMON = frozenset(
    """and or the a an in on at of to from with for by as is was are were be has had have will would can not no who that this these those my your his her our their it he she we they you me us him them but if then than so
    und oder der die das den dem des ein eine einen einem einer von mit bei aus ist war hat haben nicht kein in im am an auf zu zum zur er sie es wir ihr ich du mein dein sein wenn als dass aber
    y o el la los las un una unos unas del de con en por para es son fue ha no se su mi tu lo que cuando pero al
    e il lo gli le i uno di da dal della dei con per su si non che chi ma al alla nel nella mio tuo suo ho hai
    et ou les des du au aux avec dans sur pour par est sont ne pas ce cette je tu il elle nous vous son sa ses mon ma mes qui que quand mais
    os as um uma do dos das com na nos nas em foi tem meu seu sua mas
    here there now today tomorrow yesterday again also very just only please still never always found lost sold bought said says lives lived looking left moved won
    unser unsere unserer unserem mein meine meiner deine seine ihre eure nuestro nuestra nostro nostra notre votre nosso nossa minha
    heute morgen gestern wieder auch sehr nur hier jetzt hoy ayer otra vez aquí oggi ieri ancora anche qui aujourd hier encore aussi ici hoje ontem também aqui
    street road avenue lane drive court way st rd ave weg strasse platz gasse""".split()
)
# Articles and possessives, which stand before things and seldom before names.
ARTICLES = frozenset("the an your his her our their this that these every der die das des dem den ein eine einen einem einer eines mein meine dein seine ihre unser unsere unserem el la los las un una unos unas mi tu su nuestro nuestra il lo gli le i uno mio mia tuo sua nostro nostra les une du au aux mon ma sa ses notre votre um uma dos das meu minha seu nosso nossa del della dello dei degli delle al alla nel nella dal dalla am im zum zur beim vom ins ans".split())
# Titles, parts of family names.
TITLE = r"mr|mrs|ms|miss|dr|prof|sir|mister|herr|frau|fräulein|madame|monsieur|mme|mlle|mademoiselle|se[ñn]ora?|sra?|don|do[ñn]a|signora?|sig|senhora?|dona|dott|dottoressa"
PARTICLE = r"von|van|de|del|della|di|da|du|dos|das|la|le|zu|ter|den|al|el|bin|ben|af|av"
# Words that introduce people.
BEFORE_NAME = r"met|meet|meeting|saw|seen|see|for|to|with|by|contact|contacted|named|called|signed|dear|hello|hi|thank|thanks|is|am|are|was|traf|treffe|getroffen|sah|mit|für|an|ist|bin|heiße|vi|vu|voir|rencontré|avec|pour|par|suis|est|a|con|para|por|soy|es|conocí|visto|incontrato|per|sono|è|encontrei|com|sou|é"

# Words near an item that speak for or against a kind.
CUES = {
    "phone": "call calling phone phoned tel telephone mobile cell text sms ring fax whatsapp dial number reach dm ruf rufe anrufen telefon telefonnummer nummer handy appelle appeler appelez téléphone tél numéro portable llámame llama llamar teléfono tfno móvil chiamami chiama chiamare telefono cellulare cell numero liga ligue ligar telefone telemóvel celular",
    "id_number": "ssn passport social security sécu id card identity national insurance nino licence license tax ausweis personalausweis ausweisnummer reisepass carte identité sécurité nir dni nie nif documento pasaporte carnet codice fiscale carta identità documento cpf rg bi cidadão bilhete number numero número numéro",
    "against": "order ordered isbn ticket parcel package tracking version lat lon latitude longitude train flight bestellung paket zug commande colis pedido paquete tren ordine pacco treno encomenda pacote comboio invoice rechnung facture factura fattura score row section room page chapter minutes open km temp temperature wind level hour release build model serial ref uhr",
    "person": "met meet saw ask contact thanks dear hello hi signed named called owner neighbour neighbor landlord colleague parcel package delivery herr frau madame monsieur señor señora signor signora senhor senhora mr mrs ms dr traf getroffen vu rencontré visto vi conocí incontrato encontrei preguntar demander chiedere perguntar",
    "place": "lives live living at address party house home near in to visit street wohnt adresse feier haus bei habite chez fête maison vive calle casa fiesta dirección abita festa casa indirizzo mora morada rua parcel delivery",
}
CUE_SETS = {k: frozenset(v.split()) for k, v in CUES.items()}
# Words that follow or precede places, events and firms, and words that follow people.
PLACE_AFTER = frozenset("museum arena canal bridge station airport market hall council cup days street road lane square beach park school church festival team club university hotel hospital library theatre stadium lake river valley hills city town village county museo estación mercado gare marché bahnhof markt platz stazione mercato estação".split())
PLACE_BEFORE = frozenset("in near at of around outside inside above below under across north south east west saint san santa st lake mount cape port fort new old the bei nach aus von unter à de en di da em por entre cerca chez".split())
PERSON_AFTER = frozenset("is was has lives lived moved works worked said says wrote called who and from at in owes wants needs sells ist war hat wohnt sagt arbeitet aus est a habite dit cherche vive dice busca es abita ha dice cerca mora disse é".split())

UP = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĖĘĚĞĢĪĮİĶŁĻĽŃŅŇŌŐŒŔŘŚŞŠŢŤŪŮŰŲŹŻŽΑ-ΩА-ЯЁ"
LINK = re.compile(r"https?://\S+", re.I)
EMAIL = re.compile(r"(?<![\w@/])[^\W_](?:[\w.+%-]{0,62}\w)?(?:@|\s@\s|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)(?:[^\W_][\w-]*(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s))+[^\W\d_]{2,}(?![\w@]|\s?[\[({]\s?at\b)", re.I)
DIGIT = re.compile(r"\d")
MAYBE_EMAIL = re.compile(r"@|(?:\W|^)at\W", re.I)
DIGITS = re.compile(r"(?<![\w#@.])(?<!\d[,:/-])(?<![,:/-][,:/-])(?:\+|\(\+?|00)?\d(?:[\d()]|[ .\-/](?=[\d(])|[ ](?=\())*\d(?:[ -]?[A-Za-z](?![\w]))?(?![\w@]|[.,:/]\d)")
ALNUM = re.compile(r"(?<![\w/#@.])(?=[A-Za-z0-9 -]{0,24}\d)(?:[A-Za-z]{1,3}\d[A-Za-z0-9]{5,9}|[A-Za-z]{2}(?: ?\d{2}){3} ?[A-Za-z]|[A-Za-z]{3} ?[A-Za-z]{3} ?\d{2}[A-Za-z]\d{2} ?[A-Za-z]\d{3}[A-Za-z]|[A-Za-z]-?\d{7}-?[A-Za-z]|\d{1,2}[A-Z]\d[A-Z0-9]{4,9}|[A-Z]\d[A-Z0-9]{7,8})(?![\w@])")
WAY_EN = r"(?:street|st|road|rd|lane|ln|drive|dr|avenue|ave|court|ct|way|close|crescent|terrace|square|place|boulevard|blvd|row|hill|walk|gardens|grove)"
HOUSE = r"\d{1,4}(?:\s?(?:bis|ter|[a-d])\b)?"
NAMEW = r"[^\W\d_][^\W\d_'’-]*"
ADDRESS = [
    re.compile(rf"(?<![\w.,/-]){HOUSE},? (?:{NAMEW} ){{1,3}}{WAY_EN}\b\.?", re.I),
    re.compile(rf"(?<![\w.,/-]){HOUSE},? (?:rue|avenue|av\.|boulevard|bd|place|pl\.|impasse|allée|chemin|quai|cours|route|square)(?: (?:de la|de l['’]|du|des|de|d['’]|{NAMEW})){{1,4}}", re.I),
    re.compile(rf"(?<![\w])(?:via|viale|piazza|piazzale|corso|largo|vicolo|strada|calle|c/|avenida|avda\.?|plaza|paseo|camino|ronda|carrera|rua|travessa|praça|alameda|estrada)(?: (?:{NAMEW})){{1,4}},? ?(?:n[º°.]? ?|n[uú]m\.? |núm |numero )?{HOUSE}(?![\w])", re.I),
    re.compile(rf"(?<![\w])(?:[^\W\d_]{{3,}}(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|damm|ring|steig|hof)|(?:am|an der|auf der|im|zum|zur|unter den) (?:{NAMEW} ?){{1,3}}?|{NAMEW} (?:straße|str\.|weg|platz|allee)) ?{HOUSE}(?![\w])", re.I),
]
WORD = re.compile(r"[^\W\d_]+")
#: What may follow a given name: an initial, particles, and a family name.
REST = rf"((?: [^\W\d_]\.)?)((?: (?:{PARTICLE})(?= )){{0,2}}) ((?:[OoDd]['’])?[^\W\d_]{{2,}}(?:-[^\W\d_]{{2,}})?)(?![\w@])"
FAMILY = re.compile(REST, re.I)
GIVEN_AT = re.compile(r"(?<![\w@#/.+_’'-])([^\W\d_]{2,})(?= )")
PAIR = re.compile(rf"(?<![\w@#/.+_-])([{UP}][^\W\d_]+(?:-[{UP}][^\W\d_]+)?)(?= (?:[{UP}]\. )?(?:(?:{PARTICLE}|{PARTICLE.title()}) ){{0,2}}(?:[OoDd]['’])?[{UP}][^\W\d_])")
IS_TITLE = re.compile(TITLE, re.I).fullmatch
TITLED = re.compile(rf"(?<![\w@#])(?:{TITLE})\.? ([^\W\d_]{{2,}}(?:-[^\W\d_]{{2,}})?)(?= )", re.I)
CUED = re.compile(rf"(?<![\w@#])(?:{BEFORE_NAME}):? ([^\W\d_]{{2,}}(?:-[^\W\d_]{{2,}})?)(?= )", re.I)
DNI = "TRWAGMYFPDXBNJZSQVHLCKE"


def flat(text: str) -> tuple[str, list[int] | None]:
    """text with one plain character for each of its visible ones, and these's places in text (None: the same)."""
    if text.isascii():
        return text.replace("\t", " ").replace("\r", "\n"), None  # no item goes on in the next line
    if not changes(text):
        return text.replace("\t", " ").replace("\r", "\n"), None
    table, latin = plain_table(), latin_table()
    out, at = [], []
    for i, c in enumerate(text):
        n = ord(c)
        y = c if n < 128 else table.get(n, c)
        if y is None:
            continue
        if n >= 0x370 and len(y) == 1:
            y = latin.get(n, y)
        out.append(" " if y == "\t" else "\n" if y == "\r" else y[0])
        at.append(i)
    return "".join(out), at if len(out) != len(text) else None


def digits_of(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def luhn(d: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def candidates(x: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of everything that might be an item in a flat text."""
    out: dict[tuple[int, int, str], None] = {}
    if MAYBE_EMAIL.search(x):
        out.update({(m.start(), m.end(), "email"): None for m in EMAIL.finditer(x)})
    if DIGIT.search(x):
        for m in DIGITS.finditer(x):
            if len(digits_of(m[0])) >= 6:
                out[m.start(), m.end(), "phone"] = out[m.start(), m.end(), "id_number"] = None
        out.update({(m.start(), m.end(), "id_number"): None for m in ALNUM.finditer(x) if len(digits_of(m[0])) > 3})
        for p in ADDRESS:
            out.update({(m.start(), m.end(), "address"): None for m in p.finditer(x)})
    for m in names(x):
        f = FAMILY.match(x, m.end(1))
        if f and f[3].lower() not in COMMON and m[1].lower() not in COMMON and not IS_TITLE(m[1]):
            out[m.start(1), f.end(), "name"] = None
    if out and "://" in x:
        links = [m.span() for m in LINK.finditer(x)]
        free = lambda s, e: (n := bisect(links, (e,))) == 0 or links[n - 1][1] <= s  # noqa: E731 the last link that begins before the span's end
        return [c for c in out if free(c[0], c[1])]
    return list(out)


def names(x: str) -> Iterator[re.Match]:
    """Matches whose first group may be a given name: by form, after a title or an introducing word, or a common one."""
    yield from (m for m in GIVEN_AT.finditer(x) if (w := m[1].lower()) in GIVEN or (not w.isascii() and strip(w) in GIVEN))
    yield from TITLED.finditer(x)
    small = sum(map(str.islower, x))
    if small > 0.4 * len(x):  # else capitals mean nothing
        yield from PAIR.finditer(x)
    else:
        yield from CUED.finditer(x)
    if x.islower():
        yield from CUED.finditer(x)


def strip(w: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))


def context(x: str, start: int, end: int) -> tuple[str, str, list[str], list[float]]:
    """What stands before and after a span, the words before it, and how many of these speak for each kind and how near."""
    before, after = x[max(0, start - 40) : start], x[end : end + 24]
    words = [w.lower() for w in WORD.findall(before)]
    near = set(words[-4:])
    cue = [float(sum(w in c for w in near)) for c in CUE_SETS.values()]
    first = [next((float(i) for i, w in enumerate(reversed(words)) if w in c), 9.0) for c in CUE_SETS.values()]
    return before, after, words, [*cue, *first]


TITLE_BEFORE = re.compile(rf"(?:^|\W)(?:{TITLE})\.? $", re.I)
SENTENCE_START = re.compile(r"(?:^|[.!?…:;|/»\"”)]|RT @\w+:|@\w+)\s*$")


def name_features(x: str, start: int, end: int) -> list[float]:
    s = x[start:end]
    before, after, words, cues = context(x, start, end)
    tokens = s.split()
    given, family = tokens[0], tokens[-1]
    last, next_ = words[-1] if words else "", [w.lower() for w in WORD.findall(after)[:2]] + ["", ""]
    around = WORD.findall(x[max(0, start - 60) : start]) + WORD.findall(x[end : end + 60])
    capital = sum(w[:1].isupper() for w in around) / (len(around) or 1)
    return [
        *cues, float(strip(given.lower()) in GIVEN), float(given[:1].isupper()), float(family[:1].isupper() or family[1:3] in ("'", "’")), float(s.isupper()), float(s.islower()), float(given.isupper()), float(len(tokens)), float(len(given)), float(len(family)),
        float("." in s), float(len(tokens) > 2 and tokens[1].lower() not in COMMON), float(TITLE_BEFORE.search(before) is not None), float(SENTENCE_START.search(before) is not None), float(last in COMMON), float(last in ARTICLES), float(last in ARTICLES and bool(re.search(rf" (?:{PARTICLE}) ", s))), float(last in PLACE_BEFORE), float(given[:1].isupper() != family[:1].isupper() and family[1:2] not in "'’"),
        float(next_[0] in PLACE_AFTER), float(next_[0] in PERSON_AFTER), float(next_[0] in COMMON), float(next_[0] in PLACE_BEFORE), float(family.lower() in PLACE_AFTER), float(given.lower() in PLACE_AFTER), float(bool(re.match(r"\s*[,/(]", after))), float(bool(re.match(r"\W{0,3}\d", after))),
        float(not after.strip(" .!?🙏")), float(after[:1] == "'" or after[:1] == "’"), capital, float(x.islower()), float(x.isupper()), float(before[-2:] == ": "), float(re.match(r" [A-ZÀ-Þ]", after) is not None), float(bool(re.search(r"[A-ZÀ-Þ][^\W\d_]* $", before))),
    ]


def features(x: str, start: int, end: int, kind: str) -> list[float]:
    if kind == "name":
        return name_features(x, start, end)
    s = x[start:end]
    before, after, words, cues = context(x, start, end)
    d = digits_of(s)
    if kind == "email":
        return [*cues, float(len(s)), float(len(d)), float("@" in s), float(" " in s), float("[" in s or "(" in s), float("." in s), float(s.count(".")), float(s[:1].isupper()), float(s.isupper()), float(words[-1] in COMMON if words else 0), float(after[:1] in ",.!? /" or not after), float(re.search(r"(?i)dot|\.", s) is not None)]
    if kind == "address":
        tokens = s.split()
        number = int(d or 0)
        return [*cues, float(len(s)), float(len(tokens)), float(len(d)), float(min(number, 9999)), float(s[:1].isdigit()), float(sum(w[:1].isupper() for w in tokens) / len(tokens)), float(s.islower()), float(x.islower()), float("," in s), float(sum(w.lower() in COMMON for w in tokens)), float(words[-1] in COMMON if words else 0), float(re.match(r",? ?\d{4,5}\b", after) is not None), float(after[:1] in ",.!?\n" or not after.strip()), float(re.match(r"^\s*(?:km|m\b|%|h\b|cm|kg|€|\$|people|years|days|minutes)", after) is not None), float(bool(re.search(r"[^\W\d_]$", s)))]
    groups = re.findall(r"\d+", s)
    letters = [c for c in s if c.isalpha()]
    compact = re.sub(r"[^A-Za-z0-9]", "", s).upper()
    dni = len(compact) == 9 and compact[:8].isdigit() and compact[8].isalpha()
    nie = len(compact) == 9 and compact[0] in "XYZ" and compact[1:8].isdigit() and compact[8].isalpha()
    ni = bool(re.fullmatch(r"[A-Z]{2}\d{6}[A-Z]", compact))
    fiscal = bool(re.fullmatch(r"[A-Z]{6}\d{2}[A-Z]\d{2}[A-Z]\d{3}[A-Z]", compact))
    ssn = [len(g) for g in groups] == [3, 2, 4] and len(d) == 9 and not letters
    nir = len(d) == 15 and not letters and d[0] in "12378" or len(d) in (13, 15) and len(groups) >= 6
    date = bool(re.fullmatch(r"(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4})", s))
    return [
        *cues, float(len(s)), float(len(d)), float(len(groups)), float(max(map(len, groups), default=0)), float(len(groups[0]) if groups else 0), float(len(groups[-1]) if groups else 0),
        float(s[:1] == "+" or s[:2] == "00"), float("(" in s), float("-" in s), float("." in s), float("/" in s), float(" " in s), float(d[:1] == "0"), float(len(letters)),
        float(dni), float(nie), float(ni), float(fiscal), float(ssn), float(nir), float(date), float(len(d) > 10 and luhn(d)), float(re.fullmatch(r"\d{1,3}[.,]\d{3,}", s) is not None), float(len(groups) == 1 and not letters),
        float(d[:1] in "123"), float(before.rstrip()[-1:] in ".!?:" or not before), float(after[:1] in ",.!? /\n" or not after), float(words[-1] in COMMON if words else 0), float(re.match(r"^\s*(?:\d|km|m\b|%|h\b|cm|kg)", after) is not None), float("\n" in before[-2:]),
    ]


# ---- generated training texts ----

# Number formats, # a digit, @ a capital letter, * either, by kind; no is for look-alikes.
FORMATS = {
    "phone": """+44 7### ######|07### ######|07#########|020 #### ####|0### ### ####|(###) ###-####|###-###-####|+1 (###) ###-####|1.###.###.####|1-###-###-####|###-####|+1 ### ### ####|+33 # ## ## ## ##|0# ## ## ## ##|0#.##.##.##.##|+49 (0)## ########|01##/#######|0## ##### ###|+49 1## #######|0### ### ## ##|0## ########|+39 0## ######|0039 3## #######|3## ### ####|3## ### ## ##|0# #### ####|+34 ### ### ###|### ## ## ##|9# ### ## ##|### ### ###|+351 9## ### ###|2## ### ###|+55 ## 9####-####|(##) ####-####|+7 9## ### ## ##|###########|+## ### #### ###""".split("|"),
    "id_number": """###-##-####|### ## ####|QQ######@|QQ ## ## ## @|@@ ## ## ## @|@@######@|########@|########-@|##.###.###-@|X#######@|Y#######@|X-#######-@|Z#######@|@########|@########|@#@##@@##|@#@#####|@*******#|@@#######|C********|L********|@######|1 ## ## ## ### ### ##|2 ## ## ## ### ### ##|3 ## ## ## ### ### ##|1##############|2##############|3##############|@@@@@@##@##@###@|@@@ @@@ ##@## @###@|###.###.###-##|#########""".split("|"),
    "no": """########|######|## ### ###|# ## ###|20##-0#-1#|1#.0#.20##|1#/0#/20##|4#.####|1#.####|####-####-####|1Z #### #### ####|###-#-##-######-#|978-#-##-######-#|###-#-##-######-#|#.#.#|#.##.#|#######|#### ## ##|##########|#### #### #### ####|##:##:##""".split("|"),
}
# Phrases around a number, by kind.
PHRASES = {
    "phone": """my number is {}|call us: {}|please call {} after five|phone {}|tel {}|Tel. {}|text {} any time|ring me at {}|dial {} for a table|here is my new mobile: {}|new phone number {}|WhatsApp {}|you can reach us on {}|or {} if nobody answers|the office is on {}|mein Handy: {}|Telefon {}|bitte unter {} anrufen|ruf einfach {} an|neue Nummer {}|du erreichst mich unter {}|mon numéro est le {}|appelez le {} pour réserver|téléphone {}|tél. {}|mon nouveau portable : {}|mi número es {}|llama al {} para reservar|teléfono {}|mi móvil nuevo: {}|llámame luego al {}|il mio numero è {}|chiama il {} per prenotare|cell. {}|chiamami pure al {}|nuovo numero {}|o meu número é {}|liga para {} depois|telefone {}|{}|, {}, ask at the desk|{}\nMon to Fri|/ {}""".split("|"),
    "id_number": """my social security number is {}|SSN {}|her passport number is {}|passport {} was handed in|found an ID card, number {}|identity card {} lost on the bus|national insurance number {}|my id is {}|driving licence {}|her number is {}|the number {} is on it|registered under {}|the number on my card is {}|Personalausweis {} verloren|Ausweisnummer {}|mein Reisepass {} ist weg|mein Ausweis hat die Nummer {}|ma carte d'identité {} a disparu|numéro de sécurité sociale {}|carte {} trouvée dans le bus|mon numéro de sécu : {}|mi DNI es el {}|DNI {}|mi pasaporte {} no aparece|mi documento {} se perdió|NIE {}|il mio codice fiscale è {}|codice fiscale {}|il codice {} è il mio|carta d'identità {} smarrita|o meu documento é {}|meu CPF é {}|CPF {}|cartão de cidadão {}|they posted her mail and {}|e {}|{}""".split("|"),
    "no": """order {} has shipped|my order number is {}|ticket {} is still valid|parcel {} was delayed|tracking number {}|ISBN {}|version {} is out|release {} crashed|the minutes of {}|doors open on {}|lat {} lon {}|flight {}|row {}|Bestellung {} ist da|Paket {} kam zurück|Rechnung {}|ma commande {} est arrivée|colis {} perdu|mi pedido {} llegó|el paquete {} se retrasa|factura {}|il mio ordine {}|pacco {} in ritardo|il treno {} è in orario|a minha encomenda {}|o pedido {} atrasou|invoice {}|score {}|build {}|it costs {}|since {}|{} people came|on {}|population {}|model {}|serial {}|ref {}""".split("|"),
}
# Street types, before or after the name, and phrases around addresses, names and what looks like them.
STREETS = {
    "en": "{n} Street|{n} Road|{n} Lane|{n} Drive|{n} Avenue|{n} St|{n} Rd|{n} Ave.|Old {n} Road|{n} Hill Road|Upper {n} St|{n} Court|{n} Way".split("|"),
    "fr": "rue des {n}|rue de la {n}|avenue du {n}|place des {n}|boulevard {n}|rue {n}|rue du Petit {n}|chemin de {n}".split("|"),
    "last": "Via {n}|Via dei {n}|Via delle {n}|Viale {n}|Corso {n}|Piazza {n}|Piazza del {n}|Calle {n}|Calle del {n}|Calle de la {n}|C/ {n}|C/ los {n}|Avenida {n}|Avenida de los {n}|Plaza {n}|Plaza de las {n}|Rua {n}|Rua das {n}|Travessa do {n}|{n}straße|{n}weg|{n}gasse|{n}str.|{n}platz|{n}allee|Am {n}|Am Alten {n}|An der {n}|{n} Straße".split("|"),
}
AROUND_PLACE = "we live at {}|she lives at {} now|come to {} tonight|my address is {}|send it to {}|house for sale, {}|delivery for you at {}|meet us at {}, second floor|ich wohne in der {}|wir feiern in der {}|meine Adresse: {}|Treffpunkt {}|j'habite au {}|rendez-vous au {}|mon adresse : {}|on fête ça au {}|vivo en {}|mi dirección es {}|la cena es en {}|nos vemos en {}|abito in {}|il mio indirizzo è {}|la cena è in {}|ci vediamo in {}|moro na {}|o jantar é na {}|{}|{}, {z} {p}|{g} {f}, {}|{g} {f}\n{}|{g} {f}\n{}\n020 7946 0000|at {}, tel 020 7946 0000|anybody around {}? the gate is open|delivery for {g} {f}, {}, second floor|lives in {p}, {}".split("|")
AROUND_NAME = "{} is late|{} wants a dog|{} works here|{} called twice|{} wohnt nebenan|{} habite ici|{} vive sola|{} abita qui|{} mora perto|{}, who lives in {p}|{} from {p}|{} of {p}|{} de {p}|madame {} de {p}|señor {} de {p}|signora {} di {p}|senhor {} de {p}|Herr {} von {p}|{} von {p}|{} di {p}|monsieur {} de {p}, 01 22 33 44 55|we met {} last week|I saw {} yesterday|please ask for {}|many thanks to {} for the help|Mr {} called again|Mrs {} is late|Dr {} has a new office|they took {} home|{} is moving out|{} lives next door|{} sells old lamps|delivery for {}, second floor|a parcel for {}|our landlord is {}|the owner, {}, was there|my neighbour {} told me|dear {},|signed {}|contact {} for tickets|{} from {p} wins|{}, {p}|for the hike: {} / 020 7946 0000|ich habe {} getroffen|heute sah ich {} in {p}|Frau {} aus {p}|Herr {} ist umgezogen|{} arbeitet in {p}|ein Brief an {}|im Flur steht: {}|j'ai rencontré {} à {p}|hier j'ai croisé {}|madame {} habite ici|monsieur {} de {p} cherche du travail|{} cherche un appartement|hoy vi a {} en {p}|conocí a {}|la señora {} trabaja aquí|el señor {} llega tarde|{} busca piso|ho visto {} a {p}|il signor {} abita qui|la signora {} è partita|{} cerca casa|encontrei {} em {p}|a senhora {} mora aqui|{}\n12 {p} Road|{}\n020 7946 0000|{}, 34 {p} Street|thanks {}|this is {} speaking|with {} tonight|an interview with {}|photo by {}|{} again|{}".split("|")
NO_NAME = "{g} is late again|I saw {g} today|{g}, come home|hola {g} que tal|das ist {g} aus {p}|c'est {g} de {p}|{g} and {h} won the race|mit {g} und {h}|con {g} e {h}|avec {g} et {h}|{p} Museum is closed|the {p} Arena tonight|at {p} Airport|{p} Central Station|the {p} Canal|{p} City beat {q} Town|{p} Cup {q} Days|Visit {p} {q} Valley|New {p} opens|Lake {p}|Mount {p}|Saint {g} Square|Santa {g} beach|San {g} festival|{g} Street is closed|the {g} {p} team|{g} runs fast|{g} sings tonight|{g} can swim|{g} baila bien|{g} singt schön|{g} chante bien|{g} canta bene|{g} hatte recht|Mia madre dorme|mia zia dorme|mia cugina canta|la rosa antica|una rosa bianca|{N} von {p}|am {N} von {p}|im {N} von {p}|vor dem {N} von {p}|des {N}s von {p}|Der {N} und die {M} von {p}|Ein {N} ohne {M}|eine {M} aus {N}|{N} {M}|Kleine {M} sucht {N}|alle {M} aus dem {N}|ein Sack {N}|{M} am {N}|nach dem {N} der {M}|the {p} Council money|a {p} shop|{p}, {q}|{g} of {p}|Queen {g} of {p}|Radio {p}|Hotel {p}|Club {p}|Casa {p}|Chez {p}|la gare de {p}|le marché de {p}|el mercado de {p}|la stazione di {p}|o mercado de {p}|Mercado de {p}|Marché de {p}|Stazione di {p}|Museo de {p}|Fiesta de {p}|Festa di {p}|Rathaus {p}|bis {p} und {q}|Tel. in {p}|{p} is leaving {q}|{p} loves {q}|anyone from {p} here|Not again {p}|Good news {p}|der Hund schläft vor dem {N} von {p}|die Katze sitzt neben dem {N} von {p}|ein Vogel singt in der Mitte des {N}s von {p}|hinter dem {N} von {p} steht ein Baum|Kinder spielen hinter der {M} von {p}|das Dach des {N}s von {p} ist neu|sie warten vor dem {N} von {p}|er kauft die {M} auf dem {N} von {p}|ein Fest im {N} von {p}|wir sehen die {M} des {N}s von {p}|Regen über dem {N} von {p}|der {N} von {p} ist voll|a {w} {v} o gato|la {w} {v} il gatto|il {w} {v} la porta|el {w} {v} la puerta|le {w} {v} la porte|the {w} {v} the door|a {w} {v} again|for {w} {v} only|with {w} {v} and more|con {w} {v} y más|para {w} {v} de novo|per {w} {v} subito|pour {w} {v} encore|mit {w} {v} und so|Big News Today|Breaking News from {p}|Happy Birthday {g}|Good Morning {p}|Merry Christmas|Black Friday|{p} Folk|{p} People March|all {p} Migrants|Die {p} Brücke ist gesperrt|Der Alte {p} Hafen|Neue {p} Zeitung|Guten Morgen {p}|Rund um den {p} See|Junge Leute in {p}|La Plaza {p}|Feliz Navidad {p}|Buenos Días {p}|El Gran {p}|Buon Natale {p}|Forza {p}|Il Grande {p}|Bonjour {p}|Le Petit {p}|Bom Dia {p}|Bridge {p} | hour: 12:00; level: 2 m|Station {p} | wind: 7 km/h|Dock {p}: status = open|River {p} is rising|{p} Gate reopens|from {p} to {q}|in {p} {q} wins|Finally {g} wins|Yesterday {p} won|Tomorrow {p} sleeps|The Old Dog Of {p} Slept Near The Station|A Young Cook Sold The Red Lamp In {p}|Un Niño Compró La Lámpara Roja En {p}|Il Cuoco Ha Venduto La Lampada A {p}|Le Cuisinier A Vendu La Lampe Rouge De {p}|Der Koch Verkauft Die Rote Lampe In {p}|O Cozinheiro Vendeu A Lâmpada Em {p}".split("|")
# Common German nouns, which have capitals too.
NOUNS = "Baum Berg Bahnhof Brunnen Fluss Garten Hafen Hund Kasten Koch Laden Markt Mond Ofen Park Platz Schrank See Sohn Stein Stuhl Tag Tisch Turm Vogel Wagen Wald Weg Zaun".split()
NOUNS_F = "Arbeit Blume Brücke Burg Farbe Feier Firma Frage Gasse Glocke Karte Katze Kirche Küche Lampe Mauer Mühle Nacht Schule Sonne Straße Stunde Tasche Treppe Tür Uhr Wiese Woche Zeitung".split()
NO_STREET = "{} is closed until Friday|{} ist gesperrt seit 12 Tagen|{} est fermée|{} está cortada|{} è chiusa al traffico|3 days in {}|the 2 shops in {}|the 40 trees of {}|{} reopens".split("|")
SENTENCES = "The old dog slept near the gate|Rain again and nobody has an umbrella|They painted the kitchen green on Friday|Der Hund schläft im Garten|Gestern hat es den ganzen Tag geregnet|Die Kinder spielen vor dem Haus|Le chien dort près de la porte|Il pleut encore et personne ne sort|El perro duerme junto a la puerta|Hoy llueve otra vez y nadie sale|Il cane dorme vicino alla porta|Oggi piove di nuovo e nessuno esce|O cão dorme perto da porta|Hoje chove outra vez e ninguém sai".split("|")
REST_OF_TEXT = ["", "", "", " today", ", and nobody knew", ", what a day", ", es war spät", ", niemand kam", ", por fin", ", che giornata", ", enfin", ", que dia", " - so it goes", " The old dog slept near the gate.", " 🙏", " See you soon.", " #OpenDoors", "!", ".", "! #music", " @someone_7"]


def invented(r: random.Random, most: int = 4) -> str:
    """A word that is none: syllables as several languages have them."""
    w = "".join(r.choice(["b", "br", "c", "d", "dr", "f", "g", "gr", "h", "j", "k", "l", "m", "n", "p", "qu", "r", "s", "st", "t", "tr", "v", "w", "z", "sch", "ch"]) + r.choice(["a", "e", "i", "o", "u", "ie", "ei", "au", "é", "a", "e", "o"]) + r.choice(["", "", "n", "r", "l", "s", "nd", "tt"]) for _ in range(r.randrange(2, most)))
    return w[0].upper() + w[1:]


def generated(n: int = 9600, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Texts with the places of their items."""
    r = random.Random(seed)

    def filled(f: str) -> str:
        return "".join(str(r.randrange(10)) if c == "#" else r.choice("ABCDEFGHJKLMNPRSTVWXYZ") if c == "@" else r.choice("CFGHJKLMNPRTVWXYZ0123456789") if c == "*" else c for c in f)

    given = sorted(GIVEN)
    one = lambda: r.choice(given).title() if r.random() < 0.5 else invented(r, 3)
    family = lambda: r.choice(["", "", "", "", "", "O'", "Mc"]) + invented(r) + r.choice(["", "", "", "", "-" + invented(r, 3)])
    out = []
    for k in range(n):
        kind = ("phone", "id_number", "no", "address", "name", "no_name", "name", "no_street", "no_name", "email", "no_name", "no_name")[k % 12]
        if kind in ("phone", "id_number", "no"):
            item, around = filled(r.choice(FORMATS[kind])), r.choice(PHRASES[kind])
            gold = kind if kind != "no" else ""
        elif kind in ("address", "no_street"):
            number = f"{r.randrange(1, 240)}{r.choice(['', '', '', ' b', 'a'])}"
            style = r.choice(["en", "fr", "last", "last"])
            street = r.choice(STREETS[style]).replace("{n}", r.choice([invented(r, 3), invented(r, 3), r.choice(given).title()]))
            if kind == "no_street":
                item, around, gold = street, r.choice(NO_STREET), ""
            else:
                item = street + r.choice([" ", " ", ", ", " nº "]) + number if style == "last" else number + r.choice([" ", " ", " ", ", "]) + street if style == "en" else number + r.choice([" ", ", ", " bis "]) + street
                around, gold = r.choice(AROUND_PLACE), "address"
        elif kind == "name":
            item = one() + r.choice([" ", " ", " ", " ", f" {r.choice('ABCDEJKMPRSTXYZ')}. ", r.choice([" von ", " Du ", " de ", " van der ", " di ", " de la "])]) + family()
            around, gold = r.choice(AROUND_NAME), "name"
        elif kind == "email":
            a, b = r.choice(given), invented(r).lower()
            dot, at = r.choice([(".", "@"), (".", "@"), (".", " @ "), (" dot ", " at "), ("[dot]", "[at]"), ("(dot)", "(at)")])
            item = r.choice([f"{a}.{b}", f"{b}_{a}", f"{a}{r.randrange(99)}", f"{a}+{b}", f"{a}-{b}", f"{a[0]}{b}{r.randrange(99)}", a, b]) + at + r.choice(["mail", "post-box", "mail" + dot + "host", invented(r).lower()]) + dot + r.choice(["example", "test", "com", "org", "net", "invalid"])
            around, gold = r.choice(["my mail is {}", "mail me at {}", "write to {} for tickets", "schreib mir an {}", "mon adresse est {}", "escribe a {}", "scrivimi a {}", "escreve para {}", "{}", "{} or the desk", "who posted {} here"]), "email"
        else:
            item, around, gold = r.choice(NO_NAME).replace("{g}", r.choice(given).title()).replace("{h}", one()).replace("{p}", invented(r)).replace("{q}", invented(r)).replace("{N}", r.choice(NOUNS)).replace("{M}", r.choice(NOUNS_F)).replace("{w}", invented(r).lower()).replace("{v}", invented(r).lower()), "{}", ""
        around = r.choice(["", "", "@someone ", "RT @a_b: ", r.choice(SENTENCES) + r.choice([". ", "! ", "\n"])]) + around
        a, _, b = around.partition("{}")
        a, b = ((x.replace("{}", filled("1#.####")).replace("{p}", invented(r)).replace("{z}", filled("#####")).replace("{g}", one()).replace("{f}", family())) for x in (a, b))
        case = r.choice([str, str, str, str, str.upper, str.lower])
        if case is not str and kind in ("name", "no_name", "email", "address"):
            item = case(item) if len(case(item)) == len(item) else item
            if r.random() < 0.5:
                a, b = case(a), case(b)
        elif kind == "name" and a[:1].islower() and r.random() < 0.3:
            a = a[0].upper() + a[1:]
        text = a + item + b + (r.choice(REST_OF_TEXT) if r.random() < 0.6 else r.choice([". ", "! ", " - ", "\n"]) + r.choice(SENTENCES))
        # Names that the frame itself holds are items too, but not those to be learned from here.
        out.append((text, [(len(a), len(a) + len(item), gold)] if gold else []))
    return out


class Judges:
    """Calibrated trees and a threshold for each kind."""

    def __init__(self, n: int = 9600):
        x: dict = {k: [] for k in KINDS}
        y: dict = {k: [] for k in KINDS}
        for text, gold in generated(n):
            t = flat(text)[0]
            for s, e, kind in candidates(t):
                right = any(k == kind and s == a and abs(e - b) <= 5 for a, b, k in gold)
                # What a frame holds besides its item is neither right nor wrong.
                same = ("phone", "id_number") if kind in ("phone", "id_number") else (kind,)
                if gold and gold[0][2] not in same:
                    continue
                x[kind].append(features(t, s, e, kind))
                y[kind].append(float(right))
        self.trees, self.thresholds = {}, {}
        for kind in KINDS:
            order = np.random.default_rng(1).permutation(len(y[kind]))
            a, b = np.array(x[kind], np.float32)[order], np.array(y[kind])[order]
            m = self.trees[kind] = Calibrated(rounds=60, depth=4, rate=0.2, leaf=4.0).fit(a, b)
            p = m.calibration(m.unseen)
            cuts = np.linspace(0.2, 0.8, 25)
            f1 = [2 * (b * (p >= c)).sum() / ((p >= c).sum() + b.sum()) for c in cuts]
            self.thresholds[kind] = float(cuts[np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)].mean())  # the middle of the best


@functools.cache
def train(n: int = 9600) -> Judges:
    """Trained once a process: the training texts are always the same."""
    return Judges(n)


def items(texts: list[str | None], judges: Judges) -> list[list[tuple[str, int, int, float]]]:
    """(kind, start, end, probability) of every text's items, in order."""
    x: dict = {k: [] for k in KINDS}
    where: dict = {k: [] for k in KINDS}
    flats = []
    for k, t in enumerate(texts):
        f = flat(t) if t else None
        flats.append(f)
        for c in candidates(f[0]) if f else ():
            x[c[2]].append(features(f[0], *c))
            where[c[2]].append((k, *c))
    scored = []
    for kind in KINDS:
        if x[kind]:
            p = judges.trees[kind](np.array(x[kind], np.float32))
            scored += [(*w, v) for w, v in zip(where[kind], p.tolist(), strict=True) if v >= judges.thresholds[kind]]
    out: list[list] = [[] for _ in texts]
    taken: dict[int, list[tuple[int, int]]] = {}  # each text's accepted spans in order: no two overlap
    for k, s, e, kind, v in sorted(scored, key=lambda c: (c[0], -round(c[4], 1), c[1], -c[2], -c[4])):
        spans = taken.setdefault(k, [])
        n = bisect(spans, (s, e))
        if (n == 0 or spans[n - 1][1] <= s) and (n == len(spans) or e <= spans[n][0]):
            spans.insert(n, (s, e))
            out[k].append((kind, s, e, v))
    for k, found in enumerate(out):
        at = flats[k][1] if found else None
        if at:
            out[k] = [(kind, at[s], at[e - 1] + 1, v) for kind, s, e, v in found]
        out[k].sort(key=lambda i: i[1])
    return out


def found(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text and array<struct<kind, start_pos, end_pos, probability>> "items" of every row."""
    held = df.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start_pos", pa.int64()), ("end_pos", pa.int64()), ("probability", pa.float64())]))
        for b in batches:
            rows = [[dict(kind=k, start_pos=s, end_pos=e, probability=v) for k, s, e, v in r] for r in items(b.column(1).to_pylist(), held.value)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, kind)], names=["key", "text", "items"])

    d = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, text string, items array<struct<kind:string,start_pos:bigint,end_pos:bigint,probability:double>>")


def redacted(df: DataFrame, key: str, text: str) -> DataFrame:
    """key and the text with each item replaced by its placeholder, e.g. <PHONE>, and all else as it was."""
    f = found(df, key, text)
    # From the last item to the first, so that the places before stay right.
    r = F.aggregate(
        F.reverse(F.array_sort("items", lambda a, b: F.when(a["start_pos"] < b["start_pos"], -1).when(a["start_pos"] > b["start_pos"], 1).otherwise(0))),
        F.col("text"),
        lambda t, i: F.concat(F.substring(t, F.lit(1), i["start_pos"].cast("int")), F.lit("<"), F.upper(i["kind"]), F.lit(">"), F.substring(t, i["end_pos"].cast("int") + 1, F.length(t))),
    )
    return f.select("key", r.alias("text"))
