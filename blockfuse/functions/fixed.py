"""Values that results depend on."""

from __future__ import annotations

# ---- fixed values: source priorities -------------------------------------------------------------
CIS = ("RU", "UA", "BY", "KZ", "KG", "UZ", "TJ", "AM", "AZ", "MD")
ASIA = ("CN", "JP", "KR", "VN", "TH", "MY", "SG", "ID", "PH", "IN")
PRIORITY_CIS = ("geofeed", "sypex", "ip2loc", "maxmind", "dbip")
PRIORITY_ASIA = ("geofeed", "ip2loc", "maxmind", "dbip")
PRIORITY_DEFAULT = ("geofeed", "maxmind", "ip2loc", "dbip")
UNRANKED = 100

# ---- fixed values: country boxes (min lat, max lat, min lon, max lon) ------------------------------
BOXES = {
    "RU": (41.18, 81.85, 19.64, -169.05),
    "US": (18.92, 71.39, -171.79, -66.96),
    "CA": (41.68, 83.11, -141.0, -52.62),
    "BR": (-33.75, 5.27, -73.99, -34.79),
    "CN": (18.16, 53.55, 73.5, 134.77),
    "AU": (-43.64, -10.66, 113.15, 153.64),
    "IN": (6.75, 35.5, 68.16, 97.4),
    "DE": (47.27, 55.06, 5.87, 15.04),
    "FR": (41.33, 51.12, -5.14, 9.56),
    "GB": (49.91, 60.85, -8.62, 1.76),
    "UA": (44.39, 52.38, 22.14, 40.23),
    "BY": (51.26, 56.17, 23.18, 32.78),
    "KZ": (40.57, 55.45, 46.49, 87.32),
    "JP": (24.04, 45.55, 122.93, 145.82),
    "KR": (33.11, 38.61, 124.61, 131.87),
    "IT": (35.49, 47.1, 6.62, 18.52),
    "ES": (27.64, 43.79, -18.16, 4.32),
    "PL": (49.0, 54.84, 14.12, 24.15),
    "TR": (35.81, 42.1, 25.66, 44.83),
    "MX": (14.53, 32.72, -118.4, -86.71),
    "AR": (-55.06, -21.78, -73.58, -53.63),
}

# ---- fixed values: centroids that stand for "somewhere in the country" -----------------------------
CENTROIDS = {
    "RU": ((55.7558, 37.6173), (55.75, 37.62), (60.0, 100.0)),
    "US": ((37.751, -97.822), (39.76, -98.5)),
    "CN": ((34.7732, 113.722), (35.0, 105.0)),
    "DE": ((51.2993, 9.491), (51.0, 9.0)),
    "FR": ((46.2276, 2.2137), (46.0, 2.0)),
    "GB": ((55.3781, -3.436), (54.0, -2.0)),
    "BR": ((-14.235, -51.9253), (-10.0, -55.0)),
}
CENTROID_TOLERANCE = 0.05

# ---- fixed values: placeholders ------------------------------------------------------------------
PLACEHOLDERS = ("-", "n/a", "na", "unknown", "null", "undefined", "none")
PLACEHOLDER_PARTS = ("unavailable", "not supported", "this parameter is")

# ---- fixed values: affixes, in the order in which they are tried -----------------------------------
STATE_PREFIXES = (
    "Horad ", "horad ", "g. ", "G. ", "gor. ", "Gor. ", "Oblast ", "oblast ", "Viloyat ", "viloyat ",
    "Wilaya ", "wilaya ", "Muhafazat ", "muhafazat ", "Provincia de ", "provincia de ", "Province de ",
    "province de ", "Departamento de ", "departamento de ", "Estado de ", "estado de ",
)
STATE_SUFFIXES = (
    "-teukbyeolja-chi", "-teukbyeolja-do", "-teukbyeolsi", "-gwangyeoksi", " Qalasy", " qalasy",
    " Oblysy", " oblysy", " Viloyati", " viloyati", " Wilaayati", " wilaayati", " Muhafazah", " muhafazah",
    " Governorate", " governorate", " Province", " province", " Provincia", " provincia", " Departamento",
    " departamento", " Department", " department", " Estado", " estado", " Region", " region",
)
CITY_PREFIXES = (
    "Thanh pho ", "thanh pho ", "TP. ", "tp. ", "Ciudad de ", "ciudad de ", "City of ", "city of ",
    "Al Madinah ", "al madinah ", "Al Baladiyah ", "al baladiyah ", "Baladiyat ", "baladiyat ",
)
CITY_SUFFIXES = (
    "-shi", "-si", "-gun", "-gu", "-ku", " Shi", " shi", " City", " city", " District", " district",
    " Municipality", " municipality",
)
SOFT_SIGNS = "'`’ʼʹ′´"
SAINTS = ("saint-", "saint ", "st. ", "st-", "st ")

# ---- fixed values: misread UTF-8 -------------------------------------------------------------------
MISREAD_PUNCTUATION = {"’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
MISREAD_LETTERS = "áàâãäåæçéèêëíìîïñóòôõöøúùûüýÿÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖÚÙÛÜ"
ARTIFACTS = ("Ã", "â€", "Â", "Ð", "Ñ", "�", "’", "ʼ")
ARTIFACTS_LOWER = ("oblast'", "voblasts'")

# ---- fixed values: Cyrillic letters ----------------------------------------------------------------
CYRILLIC_LETTERS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i",
    "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t",
    "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "",
    "э": "e", "ю": "yu", "я": "ya", "і": "i", "ї": "yi", "є": "ye", "ґ": "g", "ў": "w",
}

# ---- fixed values: known cities, Cyrillic -> Latin ---------------------------------------------------
CITIES = {
    "москва": "moscow", "санкт петербург": "st petersburg", "петербург": "st petersburg",
    "нижний новгород": "nizhny novgorod", "екатеринбург": "yekaterinburg", "казань": "kazan",
    "новосибирск": "novosibirsk", "самара": "samara", "уфа": "ufa", "красноярск": "krasnoyarsk",
    "воронеж": "voronezh", "волгоград": "volgograd", "пермь": "perm", "саратов": "saratov",
    "ростов на дону": "rostov on don", "краснодар": "krasnodar", "тольятти": "tolyatti", "ижевск": "izhevsk",
    "ульяновск": "ulyanovsk", "ярославль": "yaroslavl", "барнаул": "barnaul", "владивосток": "vladivostok",
    "иркутск": "irkutsk", "хабаровск": "khabarovsk", "оренбург": "orenburg", "новокузнецк": "novokuznetsk",
    "рязань": "ryazan", "тюмень": "tyumen", "набережные челны": "naberezhnye chelny", "томск": "tomsk",
    "кемерово": "kemerovo", "астрахань": "astrakhan", "пенза": "penza", "липецк": "lipetsk", "тула": "tula",
    "киров": "kirov", "чебоксары": "cheboksary", "калининград": "kaliningrad", "брянск": "bryansk",
    "курск": "kursk", "иваново": "ivanovo", "магнитогорск": "magnitogorsk", "тверь": "tver",
    "ставрополь": "stavropol", "белгород": "belgorod", "архангельск": "arkhangelsk", "владимир": "vladimir",
    "сочи": "sochi", "курган": "kurgan", "смоленск": "smolensk", "калуга": "kaluga", "чита": "chita",
    "орел": "oryol", "волжский": "volzhsky", "череповец": "cherepovets", "вологда": "vologda",
    "мурманск": "murmansk", "сургут": "surgut", "тамбов": "tambov", "стерлитамак": "sterlitamak",
    "грозный": "grozny", "якутск": "yakutsk", "кострома": "kostroma", "комсомольск на амуре": "komsomolsk on amur",
    "петрозаводск": "petrozavodsk", "таганрог": "taganrog", "нижневартовск": "nizhnevartovsk",
    "йошкар ола": "yoshkar ola", "братск": "bratsk", "новороссийск": "novorossiysk", "дзержинск": "dzerzhinsk",
    "шахты": "shakhty", "нальчик": "nalchik", "орск": "orsk", "сыктывкар": "syktyvkar",
    "нижнекамск": "nizhnekamsk", "ангарск": "angarsk", "балашиха": "balashikha", "благовещенск": "blagoveshchensk",
    "прокопьевск": "prokopyevsk", "химки": "khimki", "псков": "pskov", "бийск": "biysk", "энгельс": "engels",
    "рыбинск": "rybinsk", "подольск": "podolsk", "южно сахалинск": "yuzhno sakhalinsk", "армавир": "armavir",
    "северодвинск": "severodvinsk", "петропавловск камчатский": "petropavlovsk kamchatsky", "сызрань": "syzran",
    "новочеркасск": "novocherkassk", "каменск уральский": "kamensk uralsky", "златоуст": "zlatoust",
    "электросталь": "elektrostal", "альметьевск": "almetyevsk", "салават": "salavat", "миасс": "miass",
    "находка": "nakhodka", "копейск": "kopeysk", "пятигорск": "pyatigorsk", "рубцовск": "rubtsovsk",
    "березники": "berezniki", "коломна": "kolomna", "мытищи": "mytishchi", "майкоп": "maykop",
    "одинцово": "odintsovo", "ковров": "kovrov", "киселевск": "kiselyovsk", "нефтеюганск": "nefteyugansk",
    "хасавюрт": "khasavyurt", "новый уренгой": "novy urengoy", "первоуральск": "pervouralsk",
    "черкесск": "cherkessk", "серпухов": "serpukhov", "димитровград": "dimitrovgrad",
    "новочебоксарск": "novocheboksarsk", "щелково": "shchyolkovo", "камышин": "kamyshin",
    "нижний тагил": "nizhny tagil", "минск": "minsk", "киев": "kyiv", "харьков": "kharkiv", "одесса": "odesa",
    "днепр": "dnipro", "львов": "lviv", "астана": "astana", "алматы": "almaty", "шымкент": "shymkent",
    "бишкек": "bishkek", "ташкент": "tashkent", "ереван": "yerevan", "баку": "baku", "кишинев": "chisinau",
    "тбилиси": "tbilisi", "душанбе": "dushanbe", "ашхабад": "ashgabat", "нур султан": "nur sultan",
}
