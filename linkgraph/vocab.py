"""Vocabularies. Fixed values, which must be these for right results, stand plainly; longer tables come from rules or parameters."""

from __future__ import annotations

import re
import unicodedata

# Surface forms of legal forms, in order of precedence among forms of equal length.
LEGAL_FORMS = {
    "limited": "LTD", "ltd": "LTD", "ltd.": "LTD", "co ltd": "LTD", "company limited": "LTD", "public limited company": "PLC", "plc": "PLC", "p.l.c.": "PLC", "llp": "LLP", "limited liability partnership": "LLP", "lp": "LP",
    "limited partnership": "LP", "cic": "CIC", "community interest company": "CIC", "unlimited": "UNLTD", "teoranta": "LTD", "cyfyngedig": "LTD", "inc": "INC", "inc.": "INC", "incorporated": "INC", "corp": "CORP",
    "corp.": "CORP", "corporation": "CORP", "llc": "LLC", "l.l.c.": "LLC", "l.p.": "LP", "pllc": "LLC", "co": "CO", "company": "CO", "gmbh": "GMBH", "mbh": "GMBH", "gmbh & co kg": "GMBH_KG", "ag": "AG", "aktiengesellschaft": "AG",
    "kg": "KG", "kgaa": "KGAA", "ug": "UG", "gesmbh": "GMBH", "sarl": "SARL", "s.a.r.l.": "SARL", "sa": "SA", "s.a.": "SA", "sas": "SAS", "s.a.s.": "SAS", "sasu": "SAS", "sca": "SCA", "sprl": "SPRL", "scs": "SCS", "sci": "SCI",
    "bv": "BV", "b.v.": "BV", "nv": "NV", "n.v.": "NV", "cv": "CV", "cooperatief": "COOP", "stichting": "STICHTING", "ab": "AB", "aktiebolag": "AB", "as": "AS", "a/s": "AS", "asa": "ASA", "aps": "APS", "oy": "OY", "oyj": "OYJ",
    "hf": "HF", "ehf": "EHF", "spa": "SPA", "s.p.a.": "SPA", "srl": "SRL", "s.r.l.": "SRL", "sl": "SL", "s.l.": "SL", "sau": "SA", "lda": "LDA", "unipessoal lda": "LDA", "sp z oo": "SPZOO", "sp. z o.o.": "SPZOO",
    "spolka z ograniczona odpowiedzialnoscia": "SPZOO", "sa spolka akcyjna": "SA", "as spolecnost": "AS", "sro": "SRO", "s.r.o.": "SRO", "kft": "KFT", "zrt": "ZRT", "nyrt": "NYRT", "doo": "DOO", "d.o.o.": "DOO", "dd": "DD", "ad": "AD",
    "eood": "EOOD", "ood": "OOD", "srl romania": "SRL", "ooo": "OOO", "o.o.o.": "OOO", "zao": "ZAO", "oao": "OAO", "pao": "PAO", "ao": "AO", "pjsc": "PAO", "ojsc": "OAO", "cjsc": "ZAO", "jsc": "AO", "joint stock company": "AO",
    "public joint stock company": "PAO", "open joint stock company": "OAO", "closed joint stock company": "ZAO", "too": "TOO", "tov": "TOV", "chp": "CHP", "as turkey": "AS", "anonim sirketi": "AS", "limited sirketi": "LTD",
    "llc uae": "LLC", "fzco": "FZCO", "fze": "FZE", "fzc": "FZC", "wll": "WLL", "sal": "SAL", "ltd israel": "LTD", "pty": "PTY", "pty ltd": "PTY_LTD", "proprietary limited": "PTY_LTD", "sdn bhd": "SDN_BHD", "sendirian berhad": "SDN_BHD",
    "bhd": "BHD", "berhad": "BHD", "pte": "PTE", "pte ltd": "PTE_LTD", "kk": "KK", "kabushiki kaisha": "KK", "yk": "YK", "gk": "GK", "co ltd japan": "LTD", "pt": "PT", "tbk": "TBK", "pvt": "PVT", "pvt ltd": "PVT_LTD",
    "private limited": "PVT_LTD", "ibc": "IBC", "international business company": "IBC", "spc": "SPC", "segregated portfolio company": "SPC", "vcc": "VCC", "foundation": "FOUNDATION", "trust": "TRUST", "trustees": "TRUST",
}

# Words before and behind a person's name.
TITLES = (
    "mr mrs ms miss mx dr prof professor sir dame lord lady baron baroness earl count countess duke duchess hon honourable rev reverend fr father capt captain col colonel gen general maj major lt lieutenant sgt sergeant adm admiral cdr he "
    "herr frau monsieur madame mme mlle senor senora signor signora dott ing arch adv advocate"
).split()
SUFFIXES = "jr junior sr senior ii iii iv v phd md mba esq cbe obe mbe kbe dbe qc kc frcs fca aca acca cfa jp ma bsc msc ba".split()
ROMAN = r"(?:i{1,3}|iv|vi{0,3}|ix|xi{0,3})"

# Letters that are romanised by table.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "і": "i", "ї": "yi", "є": "ye", "ґ": "g", "ў": "w",
}
LATIN = {"ł": "l", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ß": "ss", "æ": "ae", "œ": "oe", "å": "a", "ı": "i", "ŀ": "l", "ħ": "h", "ŋ": "n", "ŧ": "t", "ĸ": "k"}

# Words that say nothing in an address.
ADDRESS_STOPWORDS = (
    "flat apartment apt unit suite floor fl room street st road rd avenue ave lane ln drive dr close court ct place pl square sq way terrace gardens grove hill park house building bldg block the of and at po box c o care united kingdom uk "
    "england scotland wales northern ireland great britain gb"
).split()

# Jurisdictions that don't publish owners.
SECRECY = "VG KY BM BS BZ SC MU MH PA AI TC KN WS VU CW AW VC AG DM GD LI MC AD SM JE GG IM GI CY MT LU AE".split()

# Statements of control, in the order in which their beginnings are tried.
CONTROL_KINDS = {
    "ownership-of-shares": "SHARES",
    "voting-rights": "VOTING",
    "right-to-appoint-and-remove-directors": "APPOINT_DIRECTORS",
    "right-to-appoint-and-remove-members": "APPOINT_MEMBERS",
    "right-to-appoint-and-remove-person": "APPOINT_PERSON",
    "right-to-share-surplus-assets": "SURPLUS_ASSETS",
    "significant-influence-or-control": "SIGNIFICANT_INFLUENCE",
    "part-right-to-share-surplus-assets": "SURPLUS_ASSETS",
}
HARD_KINDS = ["APPOINT_DIRECTORS", "APPOINT_MEMBERS", "APPOINT_PERSON"]

# Topics of flagged entities.
SANCTION_TOPICS = ["sanction", "sanction.linked", "sanction.counter", "export.control", "export.risk"]
PEP_TOPICS = ["role.pep", "role.rca", "role.oligarch"]

# Names and demonyms of countries and territories that control filings name, by ISO code. More are given as a parameter of functions.places.country_code.
COUNTRIES = {
    "AD": ["andorra"], "AE": ["united arab emirates", "uae", "emirati"], "AG": ["antigua and barbuda"], "AI": ["anguilla"], "AL": ["albania", "albanian"], "AM": ["armenia", "armenian"],
    "AR": ["argentina", "argentine", "argentinian"], "AT": ["austria", "austrian"], "AU": ["australia", "australian"], "AW": ["aruba"], "AZ": ["azerbaijan", "azerbaijani"], "BA": ["bosnia and herzegovina", "bosnian"],
    "BB": ["barbados", "barbadian"], "BD": ["bangladesh", "bangladeshi"], "BE": ["belgium", "belgian"], "BG": ["bulgaria", "bulgarian"], "BH": ["bahrain", "bahraini"], "BM": ["bermuda", "bermudian"], "BR": ["brazil", "brazilian"],
    "BS": ["bahamas", "bahamian"], "BY": ["belarus", "belarusian", "belarussian", "byelorussian"], "BZ": ["belize", "belizean"], "CA": ["canada", "canadian"], "CH": ["switzerland", "swiss"], "CL": ["chile", "chilean"],
    "CN": ["china", "chinese", "prc", "peoples republic of china"], "CO": ["colombia", "colombian"], "CW": ["curacao"], "CY": ["cyprus", "cypriot"], "CZ": ["czech republic", "czechia", "czech"], "DE": ["germany", "german", "deutschland"],
    "DK": ["denmark", "danish"], "DM": ["dominica"], "EE": ["estonia", "estonian"], "EG": ["egypt", "egyptian"], "ES": ["spain", "spanish", "espana"], "FI": ["finland", "finnish"], "FR": ["france", "french"],
    "GB": ["united kingdom", "uk", "u k", "gb", "great britain", "britain", "british", "england", "english", "scotland", "scottish", "wales", "welsh", "northern ireland", "northern irish", "united kingdom of great britain and northern ireland", "uk citizen", "british citizen"],
    "GD": ["grenada"], "GE": ["georgia", "georgian"], "GG": ["guernsey"], "GH": ["ghana", "ghanaian"], "GI": ["gibraltar", "gibraltarian"], "GR": ["greece", "greek"], "HK": ["hong kong", "hong kong sar", "hongkong"],
    "HR": ["croatia", "croatian"], "HU": ["hungary", "hungarian"], "ID": ["indonesia", "indonesian"], "IE": ["ireland", "republic of ireland", "irish", "eire"], "IL": ["israel", "israeli"], "IM": ["isle of man", "manx"],
    "IN": ["india", "indian"], "IQ": ["iraq", "iraqi"], "IR": ["iran", "iranian"], "IS": ["iceland", "icelandic"], "IT": ["italy", "italian", "italia"], "JE": ["jersey"], "JO": ["jordan", "jordanian"], "JP": ["japan", "japanese"],
    "KE": ["kenya", "kenyan"], "KG": ["kyrgyzstan", "kyrgyz"], "KN": ["saint kitts and nevis", "st kitts and nevis", "nevis"], "KP": ["north korea", "north korean", "dprk"], "KR": ["south korea", "republic of korea", "korean"],
    "KW": ["kuwait", "kuwaiti"], "KY": ["cayman islands", "cayman", "caymanian"], "KZ": ["kazakhstan", "kazakh", "kazakhstani"], "LB": ["lebanon", "lebanese"], "LI": ["liechtenstein"], "LK": ["sri lanka", "sri lankan"],
    "LT": ["lithuania", "lithuanian"], "LU": ["luxembourg", "luxembourger", "luxembourgish"], "LV": ["latvia", "latvian"], "LY": ["libya", "libyan"], "MA": ["morocco", "moroccan"], "MC": ["monaco", "monegasque"], "MD": ["moldova", "moldovan"],
    "ME": ["montenegro", "montenegrin"], "MH": ["marshall islands"], "MK": ["north macedonia", "macedonian"], "MT": ["malta", "maltese"], "MU": ["mauritius", "mauritian"], "MX": ["mexico", "mexican"], "MY": ["malaysia", "malaysian"],
    "NG": ["nigeria", "nigerian"], "NL": ["netherlands", "the netherlands", "dutch", "holland"], "NO": ["norway", "norwegian"], "NZ": ["new zealand", "new zealander"], "OM": ["oman", "omani"], "PA": ["panama", "panamanian"],
    "PH": ["philippines", "philippine", "filipino"], "PK": ["pakistan", "pakistani"], "PL": ["poland", "polish"], "PT": ["portugal", "portuguese"], "QA": ["qatar", "qatari"], "RO": ["romania", "romanian"], "RS": ["serbia", "serbian"],
    "RU": ["russia", "russian federation", "russian"], "SA": ["saudi arabia", "saudi", "saudi arabian"], "SC": ["seychelles", "seychellois"], "SE": ["sweden", "swedish"], "SG": ["singapore", "singaporean"], "SI": ["slovenia", "slovenian"],
    "SK": ["slovakia", "slovak"], "SM": ["san marino"], "SY": ["syria", "syrian"], "TC": ["turks and caicos islands", "turks and caicos"], "TH": ["thailand", "thai"], "TJ": ["tajikistan", "tajik"], "TM": ["turkmenistan", "turkmen"],
    "TR": ["turkey", "turkiye", "turkish"], "TW": ["taiwan", "taiwanese"], "UA": ["ukraine", "ukrainian"], "US": ["united states", "united states of america", "usa", "u s a", "us", "american"], "UZ": ["uzbekistan", "uzbek"],
    "VC": ["saint vincent and the grenadines"], "VE": ["venezuela", "venezuelan"], "VG": ["british virgin islands", "bvi", "virgin islands british"], "VN": ["vietnam", "vietnamese"], "VU": ["vanuatu"], "WS": ["samoa"], "ZA": ["south africa", "south african"],
}


def country_aliases(more: dict[str, str] | None = None) -> dict[str, str]:
    """Normalised name or demonym to ISO code; more adds and overrides."""
    return {name: iso for iso, names in COUNTRIES.items() for name in names} | (more or {})


def legal_form_ranks() -> dict[str, tuple[int, str]]:
    """Normalised form to its rank and tag: more words first, then more letters, then the order of the table."""
    plain: dict[str, str] = {}
    for form, tag in LEGAL_FORMS.items():
        key = " ".join(re.sub(r"[^\w\s]", " ", form).split())
        plain.setdefault(key, tag)
    return {k: (r, plain[k]) for r, k in enumerate(sorted(plain, key=lambda k: (-len(k.split()), -len(k))))}


def folding() -> tuple[str, str, dict[str, str]]:
    """Letters with one plain letter each (as two strings for translate), and those that become none or more than one.

    The rule is compatibility decomposition without combining marks, for all of the first 0x3000 code
    points and full-width forms; the tables above come first.
    """
    one, many = {}, {}
    for c in [*range(0xA0, 0x3000), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        ch = chr(c)
        if ch != ch.lower() or unicodedata.combining(ch):
            continue
        plain = CYRILLIC.get(ch, LATIN.get(ch))
        if plain is None:
            plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if plain == ch or not plain and ch not in CYRILLIC:
            continue
        (one if len(plain) == 1 else many)[ch] = plain
    return "".join(one), "".join(one.values()), many
