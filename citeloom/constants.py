"""Fixed values.

Everything in this module is data that has to agree with the rules of the
catalogue for results to be right: word lists, codes, labels and patterns.
There is no logic here.
"""

# --- fixed values: French territory codes (ISO 3166 alpha-2, lower case) ---
TERRITORY_CODES = ["fr", "gp", "gf", "mq", "re", "yt", "pm", "mf", "bl", "wf", "tf", "nc", "pf"]

# --- fixed values: publisher names searched as whole words, any case ---
NATIONAL_PUBLISHER_WORDS = [
    "Recherche Data Gouv",
    "data.InDoRES",
    "Université de Lorraine",
    "NAKALA",
    "CIRAD",
    "INRAE",
    "INRA",
    "Ifremer",
    "DataSuds",
    "Strasbourg",
    "Paris",
    "CNES",
    "CIRAD",
    "Irstea",
    "ONERA",
    "France",
    "français",
    "française",
    "progedo",
    "Cergy-Pontoise",
    "UMS PatriNat",
    "UMR",
    "CNRS",
    "sciences po",
    "sciencespo",
    "occitanie",
    "doranum",
    "auvergne",
    "reims",
    "bordeaux",
    "nantes",
    "marseille",
    "lyon",
    "brest",
    "toulouse",
    "caen",
    "MNHN",
    "École des Hautes Études en Sciences Sociales",
    "Data Terra",
    "Supaéro",
    "Hautes Études en Sciences Sociales",
    "Institut Laue-Langevin",
    "Biologique de Roscoff",
    "histoire du temps présent",
    "IHU Méditerranée",
    "Gustave Eiffel",
    "cereq",
    "hal ccsd",
    "Nouvelle-Calédonie",
]

# --- fixed values: publisher names compared whole, after ASCII folding ---
NATIONAL_PUBLISHER_NAMES = [
    "Recherche Data Gouv",
    "Université de Lorraine",
    "NAKALA",
    "CIRAD",
    "INRAE",
    "DataSuds",
]

# --- fixed values: client id prefix of national repositories ---
NATIONAL_CLIENT_PREFIX = "inist."

# --- fixed values: keywords searched in normalised person names ---
NAME_KEYWORDS = [
    "cnrs", "saclay", "sorbonne", "inrae", "inserm", "cirad", "ifremer", "cnes",
    "paris france", "arkeopen", "cocoon",
]

# --- fixed values: keywords searched in normalised affiliation text ---
AFFILIATION_KEYWORDS = [
    "france", "french", "umr ", "cnrs", "ifremer", "cnes", "saclay", "sorbonne", "paris", " lyon",
    "marseille", "lille", "nantes", "rennes", "inrae", "inserm", "montpellier", "toulouse",
    "strasbourg", "lorraine", "toulon", "pierre simon laplace", "grenoble", "roscoff", "agrocampus",
    "nanterre", "orleans", "paul sabatier", "caen", "normandie", "jean perrin", "bordeaux",
    "ecole polytechnique", "reims", "ardenne", "la reunion", "poitiers",
    "ecole normale superieure", "saint etienne", "onera", "cirm", "savoie", "salpetriere",
    "cochin", "inria", "inra", "cea", "mondor", "roussy", "necker", "nancy", "tours",
    "avicenne", "lariboisiere",
]

# --- fixed values: author names that never count as a national author ---
EXCLUDED_FULL_NAMES = ["anne houles"]
EXCLUDED_FULL_NAMES_PUBLISHER = "UNITE Community"

# --- fixed values: family names too common to identify an author ---
EXCLUDED_LAST_NAMES = [
    "Schober", "Reimer", "Witte", "Overmann", "Bunk", "Podstawka", "Lissin", "Lüken", "Devers", "Wang", "Liu",
    "Olambo", "Smith", "Zhao", "Shi", "Zhang", "Chu", "Li", "Moore", "Tsai", "Petyuk", "Weitz", "Gritsenko",
    "Monroe", "Rodland", "Cuevas Fernandez", "Chen", "Fourrier", "Yang", "Brochard", "Wu", "Zhu", "Xu", "Zhou",
    "Huang", "de la Côte d'Or", "Sun", "Jamet", "Schmidt", "Mézard", "Metz", "Bruneau", "Yu", "Hu", "Jiang",
    "Morandière", "Ma", "Lu", "Sauneron", "He", "Steinmetz", "Bacon", "Gao", "Guo", "Urrutia", "Maseda",
    "Diener", "Wisotzki", "Bouché", "Nanayakkara", "Caruana", "Weilbacher", "Klar", "Boogaard", "Herenz",
    "Enke", "Krajnović", "Saust", "Werhahn", "Brinchman", "Kerrut", "Suarez", "Lin", "Vernier", "Bohbot",
    "Cheng", "Song", "Zheng", "Biston-Moulin", "Han", "Chang", "Vernet", "Luo", "Machefert", "Xie", "Yuan",
    "Tang", "Pérez", "Lee", "Wei", "Shen", "Feng", "Yan", "Sodini", "Liang", "Troccaz", "Péraire",
    "Burnum-Johnson", "Nicora", "Kyle", "Peng", "Xiao", "Cao", "Qian", "Kim", "Stoekl", "Dong", "Sève", "Arrif",
    "Marichal", "Fan", "Fu", "Mohamed Ibrahim", "Wesley Baldwin", "Evans", "Kumar", "Jin", "Boyd", "Dai",
    "Nguyen", "Jones", "Gout", "Yao", "Fang", "Zeng", "Ye", "Hou", "Williams", "Xia", "Cai", "Su", "Ding",
    "Liao", "Yin", "inconnu]", "Pan", "Tan", "Badin", "Du", "Maucor", "Johnson", "Tian", "Guilbaud", "Lafage",
    "Weber", "Nakayasu", "Collet", "Zou", "Piehowski", "Webb-Robertson", "Barth", "Meng", "Miller", "Brown",
    "Ren", "Deng", "Poulain", "Park", "Cui", "Ibrahim", "Silva", "Qin", "Wells", "Long", "Ji",
    "Ibrahim Mohamed", "Tao", "Hong", "Jia", "Meyer", "Singh", "Fischer", "Gu", "Sharma", "Wen", "Schneider",
    "de la Côte-d'Or", "Taylor", "Mao", "Kang", "Darras", "Qiu", "Orton", "Wagner", "Zhong", "Hall", "Hill",
    "Wilson", "Schultz",
]

# --- fixed values: genre of each general resource type (others: "other") ---
GENRE_OF_TYPE = {
    "journalarticle": "journal-article",
    "bookchapter": "book-chapter",
    "book": "book",
    "conferencepaper": "proceedings",
    "conferenceproceeding": "proceedings",
    "dataset": "dataset",
    "image": "dataset",
    "sound": "dataset",
    "audiovisual": "dataset",
    "film": "dataset",
    "physicalobject": "dataset",
    "datapaper": "datapaper",
}
GENRE_OTHER = "other"
DATASET_PUBLISHERS = ["HEPData", "PANGAEA"]

# --- fixed values: genre given by a relation to another DOI ---
GENRE_OF_RELATION = {"IsVersionOf": "version", "IsPartOf": "file", "IsIdenticalTo": "identical"}

# --- fixed values: words marking a row as a mere part of another record ---
PART_WORDS = ["version", "file"]

# --- fixed values: publishers whose versioned DOIs are copies ---
VERSION_COPY_PUBLISHERS = ["figshare", "4tu.researchdata"]
VERSION_COPY_ID_WORD = "figshare"

# --- fixed values: reasons that do not suffice for an image ---
NOISE_REASONS = "clientId;publisher"
NOISE_TYPE = "image"

# --- fixed values: subject scheme and references of classifications ---
FOS_SCHEME = "Fields of Science and Technology (FOS)"
FOS_PREFIX_CHARACTERS = "FOS: "
SUBJECT_REFERENCE = "subject-datacite"
FOS_REFERENCE = "FOS-datacite"
EXTERNAL_ID_TYPE = "datacite"

# --- fixed values: publisher canonical forms ---
# (where the text is looked for, text, canonical name); the first hit decides.
#   id       contained in the lower case DOI
#   norm     contained in the normalised publisher name
#   exact    equal to the publisher name
#   prefix   start of the lower case publisher name
#   lower    contained in the lower case publisher name
PUBLISHER_FORMS = [
    ("id", "figshare", "figshare"),
    ("norm", "cole des hautes etudes en sciences sociales", "EHESS"),
    ("norm", "nakala", "NAKALA"),
    ("norm", "sage", "SAGE"),
    ("norm", "figshare", "figshare"),
    ("norm", "strasbourg ( cds )", "Centre Données Strasbourg (CDS)"),
    ("norm", "ums patrinat", "UMS PatriNat"),
    ("exact", "Portail Data INRAE", "Portail Data INRAE"),
    (
        "exact",
        "Institut national de recherche pour l’agriculture, l’alimentation et l’environnement (INRAE)",
        "Portail Data INRAE",
    ),
    ("exact", "INRAE", "Portail Data INRAE"),
    ("prefix", "ifremer", "IFREMER"),
    ("norm", "delegation ifremer", "IFREMER"),
    ("prefix", "zenodo", "Zenodo"),
    ("lower", "cambridge crystallographic", "Cambridge Structural Database (CSD)"),
    ("lower", "fiz karlsruhe", "Inorganic Crystal Structure Database (ICSD)"),
    ("lower", "sage journal", "SAGE"),
    ("norm", "icos eric -- carbon portal", "ICOS ERIC - Carbon Portal"),
]

# --- fixed values: file format classes, (class, substrings); the first hit decides ---
FORMAT_CLASSES = [
    ("image", ["image"]),
    ("audio", ["audio"]),
    ("video", ["video"]),
    ("text", ["text"]),
    ("pdf", ["pdf"]),
    ("json", ["json"]),
    ("zip", ["zip"]),
    ("fits", ["fits"]),
    ("xml", ["xml"]),
    ("csv", ["csv"]),
    ("netcdf", ["netcdf"]),
    ("html", ["html"]),
    ("javascript", ["javascript"]),
    ("sql", ["sql"]),
    ("rdata", ["rdata"]),
    ("access", ["access"]),
    ("image", ["jpg", "jpeg", "gif", "tiff", "svg", "tif", "png"]),
    ("video", ["mp4", "mpeg", "mpg", "rec"]),
    ("text", ["word", "txt", "rtf"]),
    ("spreadsheet", ["excel", "spreadsheet", "xls"]),
    ("zip", ["tar", "zip"]),
    ("sas / stata / spss / R", ["spss", "stata", "sas", "r "]),
    ("slides", ["powerpoint", "slides"]),
    ("shapefile", ["shp", "shapefile"]),
]

# --- fixed values: size units, (units in order of trial, megabytes per unit) ---
SIZE_UNITS = [
    (["bytes", "byte"], "/ 1000000"),
    (["ko", "kb", "kbyte", "kbytes", "kio", "kib", "kilobytes"], "/ 1000"),
    (["mo", "mb", "mib", "mio", "mbyte", "mbytes", "megabytes"], "* 1"),
    (["go", "gb", "gib", "gbyte", "gbytes", "gigabytes"], "* 1000"),
    (["to", "tb", "tib", "tbyte", "tbytes", "terabytes"], "* 1000000"),
]
SIZE_COUNT_UNITS = [
    "page", "datapoint", "station", "word", "interaction", "file", "earthquake", "dataset",
    "spectrum", "spectra",
]

# --- fixed values: size categories ---
SIZE_CAT_NONE = "N/A"
SIZE_CATS = ["< 1 Mo", "1 - 10 Mo", "10 - 100 Mo", "100Mo - 1 Go", ">= 1 Go"]

# --- fixed values: path segments that do not distinguish a repository URL ---
URL_NOISE_WORDS = ["en", "index", "home"]

# --- fixed values: registry aliases, alias signature -> registered signature ---
REGISTRY_ALIASES = {
    "urgi.versailles.inrae.fr": "urgi.versailles.inrae.fr/gnpis",
    "urgi.versailles.inra.fr": "urgi.versailles.inrae.fr/gnpis",
    "campagnes.flotteoceanographique.fr": "data.ifremer.fr",
    "cdsarc.cds.unistra.fr": "cdsweb.u-strasbg.fr",
}

# --- fixed values: French articles elided before an apostrophe ---
ELIDED_ARTICLES = [
    "l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu",
]

# --- fixed values: protein entries ---
STRUCTURE_DOI = "10.2210/pdb{id}/pdb"
STRUCTURE_PUBLISHER = "Worldwide Protein Data Bank"
STRUCTURE_ID_TYPE = "crossref"
STRUCTURE_GENRE = "dataset"

# --- fixed values: file that closes a batch of dump files ---
BATCH_END_MARK = "0000.jsonl.gz"

# --- fixed values: harvest ---
SLICE_PREFIX = "dcdump-"
SLICE_STAMP = "yyyyMMddHHmmss"
ORG_SCHEMA_VERSION = "2.1"
FIRST_AUTHOR_YEAR = 2013
MIN_AUTHOR_WORKS = 5
MIN_DOI_LENGTH = 5

# Code points, as hexadecimal ranges, whose class the text normaliser takes from another
# Unicode version than the rest: marks that it keeps, format characters that it keeps, and letters, digits and
# marks that Java 17 does not know yet.
LATE_MARKS = (
    "7FD 898-89F 8CA-8E1 9FE AFA-AFF B55 C04 C3C D00 D3B-D3C D81 EBA ECE 180F 1885-1886 1ABF-1ACE "
    "1DF6-1DFB A82C A8C5 A8FF A9BD 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 "
    "11073-11074 110C2 111C9 111CF 1123E 11241 1133B 11438-1143F 11442-11444 11446 1145E 1182F-11837 "
    "11839-1183A 1193B-1193C 1193E 11943 119D4-119D7 119DA-119DB 119E0 11A01-11A0A 11A33-11A38 "
    "11A3B-11A3E 11A47 11A51-11A56 11A59-11A5B 11A8A-11A96 11A98-11A99 11C30-11C36 11C38-11C3D 11C3F "
    "11C92-11CA7 11CAA-11CB0 11CB2-11CB3 11CB5-11CB6 11D31-11D36 11D3A 11D3C-11D3D 11D3F-11D45 11D47 "
    "11D90-11D91 11D95 11D97 11EF3-11EF4 11F00-11F01 11F36-11F3A 11F40 11F42 13440 13447-13455 16F4F "
    "16FE4 1CF00-1CF2D 1CF30-1CF46 1E000-1E006 1E008-1E018 1E01B-1E021 1E023-1E024 1E026-1E02A 1E08F "
    "1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF 1E944-1E94A"
)
LATE_FORMATS = (
    "890-891 8E2 110CD 13430-1343F"
)
LATE_WORDS = (
    "870-887 889-88E 897 8B5 8C8-8C9 C5D CDD CF3 170D 1715 171F 1B4C 1C89-1C8A 2C2F 2C5F A7C0-A7C1 "
    "A7CB-A7CD A7D0-A7DC A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 "
    "105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3 10780-10785 10787-107B0 107B2-107BA 10D40-10D65 "
    "10D69-10D6D 10D6F-10D85 10EC2-10EC4 10EFC 10F70-10F81 11071-11072 11075 1123F-11240 11380-11389 "
    "1138B 1138E 11390-113B5 113B7-113C0 113C2 113C5 113C7-113CA 113CC-113D3 113E1-113E2 116D0-116E3 "
    "11740-11746 11AB0-11ABF 11BC0-11BE0 11BF0-11BF9 11F02-11F10 11F12-11F35 11F3E-11F3F 11F41 "
    "11F50-11F5A 12F90-12FF0 1342F 13441-13446 13460-143FA 16100-16139 16A70-16ABE 16AC0-16AC9 "
    "16D40-16D6C 16D70-16D79 18CFF 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 "
    "1CCF0-1CCF9 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E4F0-1E4F9 1E5D0-1E5FA "
    "1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2EBF0-2EE5D 31350-323AF"
)
# Capitals that Python 3.13 does not know yet, with the first of their small letters.
LATE_CAPITALS = "1C89:1C8A A7CB:264 A7CC:A7CD A7CE:A7CF A7D2:A7D3 A7D4:A7D5 A7DA:A7DB A7DC:19B 10D50-10D65:10D70 16EA0-16EB8:16EBB"
