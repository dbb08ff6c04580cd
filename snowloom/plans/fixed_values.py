"""Names, codes and rules that somebody found by hand.

All values in this module are data. They must be exactly these for results to be right.
"""

# ruff: noqa: E501

# Names in the country list and the names the code list gives the same countries.
COUNTRY_ALIASES = {
    "Congo, Repub. of the": "Republic of the Congo",
    "Korea, North": "North Korea",
    "Congo, Dem. Rep.": "Democratic Republic of the Congo",
    "Burma": "Myanmar",
    "Central African Rep.": "Central African Republic",
    "Macau": "Macao",
    "Micronesia, Fed. St.": "Micronesia",
    "Virgin Islands": "U.S. Virgin Islands",
    "N. Mariana Islands": "Northern Mariana Islands",
    "Gambia, The": "Gambia",
    "Cote d'Ivoire": "Ivory Coast",
    "St Pierre & Miquelon": "Saint Pierre and Miquelon",
    "British Virgin Is.": "British Virgin Islands",
    "Korea, South": "South Korea",
    "Bahamas, The": "Bahamas",
    "Trinidad & Tobago": "Trinidad and Tobago",
    "Bosnia & Herzegovina": "Bosnia and Herzegovina",
    "Antigua & Barbuda": "Antigua and Barbuda",
    "Sao Tome & Principe": "Sao Tome and Principe",
    "Saint Kitts & Nevis": "Saint Kitts and Nevis",
    "Turks & Caicos Is": "Turks and Caicos Islands",
}

# Country names in the laureate list and their conformed names.
LAUREATE_COUNTRY_ALIASES = {
    "United States of America": "United States",
    "Guadeloupe Island": "Guadeloupe",
    "Germany (Poland)": "Germany",
    "Germany (France)": "Germany",
    "Germany (Russia)": "Germany",
    "Poland (Ukraine)": "Poland",
    "Poland (Lithuania)": "Poland",
    "Poland (Belarus)": "Poland",
    "Hungary (Slovakia)": "Hungary",
    "India (Pakistan)": "India",
    "W&uuml;rttemberg (Germany)": "Württemberg (Germany)",
}

# Codes that stand for a country under another name, so their own name is no missing country.
CODES_WITHOUT_COUNTRY = ["BQ", "CW", "SX", "PS"]

CONTINENT_NAMES = {
    "NA": "NORTH AMERICA",
    "SA": "SOUTH AMERICA",
    "AS": "ASIA",
    "AN": "ANTARCTICA",
    "OC": "AUSTRALIA/OCEANIA",
    "EU": "EUROPE",
    "AF": "AFRICA",
}

# Countries whose continent the code list does not give.
CONTINENT_OVERRIDES = {
    "Gaza Strip": "ASIA",
    "Netherlands Antilles": "NORTH AMERICA",
    "West Bank": "ASIA",
}

CAPITAL_OVERRIDES = {
    "Scotland": "Edinburgh",
    "Northern Ireland": "Belfast",
    "Netherlands Antilles": "Willemstad",
    "West Bank": "East Jerusalem",
    "Gaza Strip": "East Jerusalem",
}

# Code that two countries share, by country.
FORCED_CODES = {
    "Gaza Strip": "PS",
    "West Bank": "PS",
}

# Country that several codes share, by code.
FORCED_COUNTRIES = {
    "BQ": "Netherlands Antilles",
    "CW": "Netherlands Antilles",
    "SX": "Netherlands Antilles",
}

# The same sharing in the city list: merged codes, a code that repeats another, a code cut by longitude.
MERGED_CITY_CODES = {
    "bq": "an",
    "cw": "an",
    "sx": "an",
}
DUPLICATE_CITY_CODE = "zr"
SPLIT_CITY_CODE = "ps"
SPLIT_LONGITUDE = 34.8
SPLIT_WEST = "ps_gs"
SPLIT_EAST = "ps_wb"
SPLIT_NAMES = {
    "West Bank": "ps_wb",
    "Gaza Strip": "ps_gs",
}

# Country whose cities the laureate list writes as "city, STATE".
STATE_COUNTRY = "us"

# Patterns of historical country names and the country of today. The first that fits counts. A pattern
# without % is the whole name.
COUNTRY_PARENTS = [
    (["%(Poland)"], "Poland"),
    (["%(Austria)"], "Austria"),
    (["%(Croatia)"], "Croatia"),
    (["%(Czech Republic)", "%Czechoslovakia%"], "Czech Republic"),
    (["%(Hungary)"], "Hungary"),
    (["%(Slovenia)"], "Slovenia"),
    (["%(Ukraine)"], "Ukraine"),
    (["%(Italy)"], "Italy"),
    (["%(Germany)", "East Germany", "Federal Republic of Germany"], "Germany"),
    (["%(Israel)"], "Israel"),
    (["%(Bangladesh)"], "Bangladesh"),
    (["%(India)"], "India"),
    (["%(Saint Lucia)"], "Saint Lucia"),
    (["%(Greece)"], "Greece"),
    (["%(Denmark)"], "Denmark"),
    (["%(Algeria)"], "Algeria"),
    (["%(Ghana)"], "Ghana"),
    (["%(Slovakia)"], "Slovakia"),
    (["%(Turkey)"], "Turkey"),
    (["%(Zambia)"], "Zambia"),
    (["%(Iran)"], "Iran"),
    (["%(Belarus)"], "Belarus"),
    (["%(Russia)", "%Union of Soviet Socialist Republics%"], "Russia"),
    (["%(Lithuania)"], "Lithuania"),
    (["%(Azerbaijan)"], "Azerbaijan"),
    (["%(Finland)"], "Finland"),
    (["%(Latvia)"], "Latvia"),
    (["%France)"], "France"),
    (["%(Zimbabwe)"], "Zimbabwe"),
    (["%(Pakistan)"], "Pakistan"),
    (["%China)"], "China"),
    (["%(Indonesia)"], "Indonesia"),
    (["%(Serbia)"], "Serbia"),
    (["%(Republic of Macedonia)"], "Macedonia"),
    (["%(Bosnia%"], "Bosnia and Herzegovina"),
    (["Northern Ireland", "Scotland"], "United Kingdom"),
    (["%(South Korea)"], "South Korea"),
    (["Trinidad"], "Trinidad and Tobago"),
    (["%(Myanmar)"], "Myanmar"),
]

# Organizations that are part of another one: patterns of name, city and country; then name, city and
# country of the parent. None means any. The mark behind the city means: any city but this one.
ORGANIZATION_PARENTS = [
    (["Australian National University"], "Weston Creek", False, None, "Australian National University", "Canberra", None),
    (["Bell Laboratories"], "Holmdel, NJ", False, None, "Bell Laboratories", "Murray Hill, NJ", None),
    (["Bell Telephone Laboratories"], None, False, None, "Bell Laboratories", "Murray Hill, NJ", None),
    (["Columbia University Division%"], None, False, None, "Columbia University", None, None),
    (["Duke University %"], None, False, None, "Duke University", None, None),
    (["%Fritz-Haber-Institut%", "%Max-Planck%", "%Max Planck Institute%"], None, False, None, "Max Planck Society", None, None),
    (["Harvard University,%"], None, False, None, "Harvard University", None, None),
    (["I.G. Farbenindustrie A.G."], "Heidelberg", False, None, "I.G. Farbenindustrie A.G.", "Mannheim-Rheinau", None),
    (["Imperial Cancer Research Fund Laboratory"], None, False, None, "Imperial Cancer Research Fund", None, None),
    (["Johns Hopkins University School of Medicine"], None, False, None, "Johns Hopkins University", None, None),
    (["Karolinska Institutet, Nobel Medical Institute"], None, False, None, "Karolinska Institutet", None, None),
    (["Kiel University"], None, False, "Federal Republic of Germany", "Kiel University", None, "Germany"),
    (["London University,%"], None, False, None, "London University", None, None),
    (["Massachusetts Institute of Technology (MIT),%"], None, False, None, "Massachusetts Institute of Technology (MIT)", None, None),
    (["New York University, College of Medicine"], None, False, None, "New York University", None, None),
    (["P.N. Lebedev Physical Institute"], None, False, "Union of Soviet Socialist Republics", "P.N. Lebedev Physical Institute", None, "Russia"),
    (["Rockefeller Institute for Medical Research"], None, False, None, "Rockefeller University", None, None),
    (["Sorbonne University, Institut Henri Poincaré"], None, False, None, "Sorbonne University", None, None),
    (["Stanford University School of Medicine"], None, False, None, "Stanford University", None, None),
    (["University of California%"], "Berkeley, CA", True, None, "University of California", "Berkeley, CA", None),
    (["University of Chicago, Ben May Laboratory for Cancer Research"], None, False, None, "University of Chicago", None, None),
    (["University of Colorado, JILA"], None, False, None, "University of Colorado", None, None),
    (["University of Freiburg"], None, False, None, "University of Freiburg im Breisgau", None, None),
    (["University of Heidelberg"], None, False, "Federal Republic of Germany", "University of Heidelberg", None, "Germany"),
    (["University of Oxford, Royal Society"], None, False, None, "University of Oxford", None, None),
    (["University of Texas %"], None, False, None, "University of Texas", None, None),
    (["University of Tokyo"], "Kashiwa", False, None, "University of Tokyo", "Tokyo", None),
    (["University of Zurich, Institute of Experimental Immunology"], None, False, None, "University of Zurich", None, None),
    (["Vanderbilt University School of Medicine"], None, False, None, "Vanderbilt University", None, None),
    (["Veterans Administration Hospital"], "New Orleans, LA", False, None, "Veterans Administration Hospital", "Bronx, NY", None),
    (["Yale University, School of Medicine"], None, False, None, "Yale University", None, None),
]

# Parents that the laureate list itself does not name: name, country, city.
PARENT_ORGANIZATIONS = [
    ("Duke University", "United States", "Durham, NC"),
    ("Max Planck Society", "Germany", "Munich"),
    ("University of California", "United States", "Berkeley, CA"),
]

# Places of organizations the laureate list leaves out or gets wrong.
ORGANIZATION_CITIES = {
    "Howard Hughes Medical Institute": "Durham, NC",
    "University of Delaware": "Newark, DE",
}
ORGANIZATION_COUNTRIES = [
    ("Howard Hughes Medical Institute", None, "United States"),
    ("Institut Pasteur", "Tunis", "Tunisia"),
]

# Country names of the time, found in the laureate list, that no other list has.
HISTORICAL_COUNTRIES = [
    "British Protectorate of Palestine (Israel)",
    "Württemberg (Germany)",
    "Czechoslovakia (Czech Republic)",
    "Russian Empire (Latvia)",
    "Trinidad",
    "Austria-Hungary (Poland)",
    "Schleswig (Germany)",
    "Russian Empire (Poland)",
    "British India (India)",
    "British West Indies (Saint Lucia)",
    "Tuscany (Italy)",
    "Bosnia (Bosnia and Herzegovina)",
    "Austria-Hungary (Ukraine)",
    "Russian Empire (Lithuania)",
    "Austria-Hungary (Slovenia)",
    "Austria-Hungary (Hungary)",
    "German-occupied Poland (Poland)",
    "Austria-Hungary (Bosnia and Herzegovina)",
    "Faroe Islands (Denmark)",
    "Austrian Empire (Czech Republic)",
    "Korea (South Korea)",
    "French Algeria (Algeria)",
    "Ottoman Empire (Turkey)",
    "West Germany (Germany)",
    "Austrian Empire (Italy)",
    "Prussia (Germany)",
    "Russian Empire (Ukraine)",
    "British Mandate of Palestine (Israel)",
    "Mecklenburg (Germany)",
    "Persia (Iran)",
    "Crete (Greece)",
    "Gold Coast (Ghana)",
    "Tibet (People's Republic of China)",
    "Austria-Hungary (Czech Republic)",
    "Prussia (Poland)",
    "Russian Empire (Belarus)",
    "Russian Empire (Azerbaijan)",
    "Union of Soviet Socialist Republics (Belarus)",
    "Southern Rhodesia (Zimbabwe)",
    "Burma (Myanmar)",
    "Russian Empire (Russia)",
    "Hesse-Kassel (Germany)",
    "Austria-Hungary (Croatia)",
    "Free City of Danzig (Poland)",
    "Prussia (Russia)",
    "British India (Bangladesh)",
    "Ottoman Empire (Republic of Macedonia)",
    "Austria-Hungary (Austria)",
    "East Friesland (Germany)",
    "Union of Soviet Socialist Republics (Russia)",
    "Java, Dutch East Indies (Indonesia)",
    "Russian Empire (Finland)",
    "Scotland",
    "Northern Ireland",
    "Bavaria (Germany)",
    "Austrian Empire (Austria)",
    "Union of Soviet Socialist Republics",
    "Northern Rhodesia (Zambia)",
    "Czechoslovakia",
    "Yugoslavia (Serbia)",
    "East Germany",
    "Federal Republic of Germany",
    "Alsace (then Germany, now France)",
]


# Places in the laureate list; the city that stands for each: its name, region and country code.
CITY_OVERRIDES = [
    ("Casteldàwson", "Castledawson", "S7", "gb"),
    ("Grand Valley, CO", "Green Valley Acres", "CO", "us"),
    ("Yamanashi Prefecture", "Yamanashi", "37", "jp"),
    ("Amherst, NS", "Amherst", "07", "ca"),
    ("Champaign-Urbana, IL", "Champaign", "IL", "us"),
    ("Danzig (Gdansk)", "Danzig", "82", "pl"),
    ("Fleräng", "Uppsala", "21", "se"),
    ("Kattowitz (Katowice)", "Kattowitz", "83", "pl"),
    ("Hobart, Tasmania", "Hobart", "06", "au"),
    ("Leningrad (Saint Petersburg)", "Leningrad", "66", "ru"),
    ("Gaffken (Parusnoye)", "Gaffken", "23", "ru"),
    ("Rufford, near Chesterfield", "Rufford", "H2", "gb"),
    ("Goldschmieden, near Breslau", "Breslau", "72", "pl"),
    ("Kibbutz Sde-Nahum", "Sede Nahum", "03", "il"),
    ("Hansdorf (Lawice)", "Hansdorf", "85", "pl"),
    ("Toyama City", "Toyama", "08", "jp"),
    ("St. Petersburg", "Sankt-Peterburg", "66", "ru"),
    ("Aldea Chimel", "Chimel", "01", "gt"),
    ("Vicuña", "Vicuna", "07", "cl"),
    ("Dippenhall", "Farnham", "E4", "gb"),
    ("Königshütte (Chorzów)", "Königshütte", "14", "de"),
    ("Skedsmo", "Skedsmokorset", "01", "no"),
    ("Kingston, ON", "Kingston", "08", "ca"),
    ("Leggiuno-Sangiano", "Varese", "09", "it"),
    ("Taktser", "Qinghaihu", "06", "cn"),
    ("Gränichen", "Granichen", "01", "ch"),
    ("Neisse (Nysa)", "Neisse", "79", "pl"),
    ("St. Columb Minor", "Saint Columb Minor", "C6", "gb"),
    ("Zelvas", "Zelva", "60", "lt"),
    ("Olympus, TN", "Byrdstown", "TN", "us"),
    ("Sorau (Zory)", "Sorau in Nieder Lausitz", "76", "pl"),
    ("Gjesdal", "Ålgård", "14", "no"),
    ("Viipuri (Vyborg)", "Viipuri", "42", "ru"),
    ("Kvikne", "Kviknepladsen", "06", "no"),
    ("Nuoro, Sardinia", "Nuoro", "14", "it"),
    ("Priluka (Nova Pryluka)", "Priluka Novaya", "23", "ua"),
    ("Laibach (Ljubljana)", "Laibach", "04", "si"),
    ("Smyrna (Izmir)", "Smyrna", "35", "tr"),
    ("Mexico City", "Mexico", "09", "mx"),
    ("Timmins, ON", "Timmins", "08", "ca"),
    ("San José, CA", "San Jose", "CA", "us"),
    ("Jamaica Plain, MA (Boston)", "Jamaica Plain", "MA", "us"),
    ("Nitzkydorf, Banat", "Nitzkydorf", "36", "ro"),
    ("Waltersdorf (Niegoslawice)", "Waltersdorf", "76", "pl"),
    ("Agrigento, Sicily", "Agrigento", "15", "it"),
    ("Medicine Hat, Alberta", "Medicine Hat", "01", "ca"),
    ("&#346;eteniai", "Kedainiai", "60", "lt"),
    ("Kharkov (Kharkiv)", "Kharkov", "07", "ua"),
    ("Wailacama", "Dukuh Kupang Timur", "08", "id"),
    ("Pressburg (Bratislava)", "Pressburg", "02", "sk"),
    ("Lennep (Remscheid)", "Lennep", "07", "de"),
    ("Higashimatsuyama", "Higashi-Matsuyama", "34", "jp"),
    ("Nam Ha province", "Phu Ly", "80", "vn"),
    ("Cheetham Hill, near Manchester  ", "Manchester", "I2", "gb"),
    ("Kingston Hill", "London", "H9", "gb"),
    ("Hofei, Anhwei", "Hefei", "01", "cn"),
    ("St. Louis, MO", "Saint Louis", "MO", "us"),
    ("Dabrovica", "Dabrowica", "77", "pl"),
    ("Mount Verno, NY", "Mount Vernon", "NY", "us"),
    ("Ta'izz", "Taiz", "11", "ye"),
    ("Mit Abu al-Kawm", "Mit Abu al Kawm", "09", "eg"),
    ("Chidambaram, Tamil Nadu", "Chidambaram", "25", "in"),
    ("Tananarive (Antananarivo)", "Tananarive", "05", "mg"),
    ("Frankfurt-on-the-Main", "Frankfurt am Main", "05", "de"),
    ("Hoechst", "Frankfurt am Main", "05", "de"),
    ("Jhang Maghi&#257;na", "Jhang", "12", "in"),
    ("Zhejiang Ningbo", "Ningbo", "14", "cn"),
    ("Wilno (Vilnius)", "Wilno", "65", "lt"),
    ("Langford Grove, Maldon, Essex", "Langford", "E4  ", "gb"),
    ("Clausthal (Clausthal-Zellerfeld)", "Clausthal", "06", "de"),
    ("Strassburg (Strasbourg)", "Strassburg", "C1  ", "fr"),
    ("Rangoon (Yangon)", "Rangoon", "17", "mm"),
    ("Strehlen (Strzelin)", "Strehlen", "72", "pl"),
    ("Buczacz (Buchach)", "Buczacz", "22", "ua"),
    ("Kalgoorlie", "Boulder", "08", "au"),
    ("Nizhny Tagil", "Nizhnii Tagil", "71", "ru"),
    ("Bremerhaven-Lehe", "Bremerhaven", "03", "de"),
    ("Corteno", "Brescia", "09", "it"),
    ("Windsor, ON", "Windsor", "08", "ca"),
    ("Bnin (Kórnik)", "Bnin", "86", "pl"),
    ("Iria Flavia", "Iria", "58", "es"),
    ("Breslau (Wroclaw)", "Breslau", "72", "pl"),
    ("Uskup (Skopje)", "Üsküp", "39", "tr"),
    ("Koenigsberg (Kaliningrad)", "Königsberg", "23", "ru"),
    ("Reykjavik", "Reykjavík", "10", "is"),
    ("Petilla de Aragó", "Petilla de Aragón", "32", "es"),
    ("'s Graveland", "'s-Graveland", "07", "nl"),
    ("Zloczov", "Zloczow", "15", "ua"),
    ("Vishneva", "Wisniowa", "77", "pl"),
    ("St. Paul, MN", "Saint Paul", "MN", "us"),
    ("Kristiania (Oslo)", "Kristiania", "12", "no"),
    ("Rendcombe", "Cirencester", "E6", "gb"),
    ("Vitebsk, Belorussia", "Vitebsk", "07", "by"),
    ("Mürzzuschlag", "Murzzuschlag", "06", "at"),
    ("Val di Castello", "Pietrasanta", "16", "it"),
    ("Glencorse", "Midlothian", "V5", "gb"),
    ("Strelno (Strzelno)", "Strelno", "73", "pl"),
    ("Lochfield", "Lichfield", "N1", "gb"),
    ("the Hague", "The Hague", "11", "nl"),
    ("Ivano-Frankivsk", "IvanoFrankivsk", "06", "ua"),
    ("Victoria, BC", "Victoria", "02", "ca"),
    ("Lethbridge, Alberta", "Lethbridge", "01", "ca"),
    ("Wickenberg, AZ", "Wickenburg", "AZ", "us"),
    ("Grantchester", "Cambridgeshire", "C3", "gb"),
    ("Wakulla Springs State Park, FL  ", "Wakulla Springs", "FL", "us"),
    ("Presqu'île-de-Giens", "Giens", "B8", "fr"),
    ("Newfoundland", "Saint John's", "05", "ca"),
    ("New Jersey, NJ", "Jersey City", "NJ", "us"),
    ("Penrhyndeudraeth", "Penrhyndeudreath", "Y2", "gb"),
    ("Perranarworthal", "County of Cornwall", "C6", "gb"),
    ("Llangarron", "Ross on Wye", "F7", "gb"),
    ("Kraków", "Krakow", "77", "pl"),
    ("Hamilton, Ontario", "Hamilton", "08", "ca"),
    ("Putney Heath", "London", "H9", "gb"),
    ("Shipston-on-Stour", "Shipston on Stour", "P3", "gb"),
    ("Brive-Corrèze", "Brive-la-Gaillarde", "B1", "fr"),
    ("Övralid", "Motala", "16", "se"),
    ("Bornheim-Merten", "Merten", "07", "de"),
    ("Truro, NS", "Truro", "07", "ca"),
    ("Waterford, CT", "New London", "CT", "us"),
    ("West Berlin", "Berlin", "16", "de"),
    ("Palma, Majorca", "Palma de Mallorca", "07", "es"),
    ("Ayot St. Lawrence", "Ayot Saint Lawrence", "F8", "gb"),
    ("Moffett Field, CA", "Santa Clara", "CA", "us"),
    ("Lewes, East Sussex", "Lewes", "E2", "gb"),
    ("Agnetendorf (Jagniatków)", "Jelenia Gora", "72", "pl"),
    ("Research Triangle Park, NC", "Raleigh", "NC", "us"),
    ("Bucksburn (Scotland)", "Bucksburn", "T5", "gb"),
    ("Lidingö-Stockholm", "Lidingö", "26", "se"),
    ("Breisgau", "Freiburg im Breisgau", "01", "de"),
    ("J&uuml;lich", "Jülich", "07", "de"),
    ("Mannheim-Rheinau", "Rheinau", "01", "de"),
    ("Sapporo", "Sapporo-shi", "12", "jp"),
    ("Berlin-Dahlem", "Dahlem", "16", "de"),
    ("Long Island, New York, NY", "Long Island City", "NY", "us"),
    ("Harwell, Berkshire", "Harwell", "K2", "gb"),
    ("Argonne, IL", "Lemont", "IL", "us"),
    ("Altenberg; Grünau im Almtal", "Altenberg", "04", "at"),
    ("Massachusetts, MA", "Boston", "MA", "us"),
    ("Mülheim/Ruhr", "Mülheim an der Ruhr", "07", "de"),
    ("Rüschlikon", "Zurich", "25", "ch"),
    ("Kyoto", "Kyoto-shi", "22", "jp"),
    ("Guebwiller", "Guebwiller", "C1", "fr"),
    ("Lahore", "Lahore", "02", "pk"),
    ("Thorshavn", "Thorshavn", "00", "fo"),
    ("Cluny", "Offord Cluny", "C3", "gb"),
    ("Lagow", "Lagow", "72", "pl"),
    ("Neuchâtel", "Neuchâtel", "A6", "fr"),
    ("Kaysersberg", "Kaysersberg", "C1", "fr"),
    ("Dili", "Dukuh Kupang Timur", "08", "id"),
    ("Bad Salzbrunn", "Bad Salzbrunn", "72", "pl"),
    ("San Juan", "San Juan", "PR", "us"),
    ("Lanzarote", "Arrecife", "53", "es"),
    ("Hong Kong", "Hong Kong", "00", "hk"),
]
