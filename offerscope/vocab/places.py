"""French administrative names and the city reference."""

from __future__ import annotations

# Region -> department codes.
REGION_DEPARTMENTS = {
    "Île-de-France": "75 77 78 91 92 93 94 95",
    "Auvergne-Rhône-Alpes": "01 03 07 15 26 38 42 43 63 69 73 74",
    "Bourgogne-Franche-Comté": "21 25 39 58 70 71 89 90",
    "Bretagne": "22 29 35 56",
    "Centre-Val de Loire": "18 28 36 37 41 45",
    "Corse": "2A 2B",
    "Grand Est": "08 10 51 52 54 55 57 67 68 88",
    "Hauts-de-France": "02 59 60 62 80",
    "Normandie": "14 27 50 61 76",
    "Nouvelle-Aquitaine": "16 17 19 23 24 33 40 47 64 79 86 87",
    "Occitanie": "09 11 12 30 31 32 34 46 48 65 66 81 82",
    "Pays de la Loire": "44 49 53 72 85",
    "Provence-Alpes-Côte d'Azur": "04 05 06 13 83 84",
    "Outre-mer": "971 972 973 974 976",
}

# Department names (lower case, no accents, blanks for hyphens) -> code.
DEPARTMENT_CODES = {
    "ain": "01", "aisne": "02", "allier": "03", "alpes de haute provence": "04", "hautes alpes": "05",
    "alpes maritimes": "06", "ardeche": "07", "ardennes": "08", "ariege": "09", "aube": "10", "aude": "11",
    "aveyron": "12", "bouches du rhone": "13", "calvados": "14", "cantal": "15", "charente": "16",
    "charente maritime": "17", "cher": "18", "correze": "19", "cote d or": "21", "cotes d armor": "22",
    "creuse": "23", "dordogne": "24", "doubs": "25", "drome": "26", "eure": "27", "eure et loir": "28",
    "finistere": "29", "corse du sud": "2A", "haute corse": "2B", "gard": "30", "haute garonne": "31",
    "gers": "32", "gironde": "33", "herault": "34", "ille et vilaine": "35", "indre": "36",
    "indre et loire": "37", "isere": "38", "jura": "39", "landes": "40", "loir et cher": "41", "loire": "42",
    "haute loire": "43", "loire atlantique": "44", "loiret": "45", "lot": "46", "lot et garonne": "47",
    "lozere": "48", "maine et loire": "49", "manche": "50", "marne": "51", "haute marne": "52",
    "mayenne": "53", "meurthe et moselle": "54", "meuse": "55", "morbihan": "56", "moselle": "57",
    "nievre": "58", "nord": "59", "oise": "60", "orne": "61", "pas de calais": "62", "puy de dome": "63",
    "pyrenees atlantiques": "64", "hautes pyrenees": "65", "pyrenees orientales": "66", "bas rhin": "67",
    "haut rhin": "68", "rhone": "69", "haute saone": "70", "saone et loire": "71", "sarthe": "72",
    "savoie": "73", "haute savoie": "74", "paris": "75", "seine maritime": "76", "seine et marne": "77",
    "yvelines": "78", "deux sevres": "79", "somme": "80", "tarn": "81", "tarn et garonne": "82", "var": "83",
    "vaucluse": "84", "vendee": "85", "vienne": "86", "haute vienne": "87", "vosges": "88", "yonne": "89",
    "territoire de belfort": "90", "essonne": "91", "hauts de seine": "92", "seine saint denis": "93",
    "val de marne": "94", "val d oise": "95", "guadeloupe": "971", "martinique": "972", "guyane": "973",
    "la reunion": "974", "mayotte": "976",
}

# Whole texts that name no place, and the wording stripped from a place.
NOT_A_PLACE = ("france", "france entiere", "teletravail", "remote")
DEPARTMENT_PREFIX = r"^\s*(\d{2,3}|2[AB])\s*-\s*([^\n]+)$"
DISTRICT_HEAD = r"^\d{1,2}\s*(?:e|er|eme|ème)?[\s-]*(?:arrondissement|$)"
PLACE_SUFFIXES = (
    r"\s+\d{1,2}\s*(?:e|er|eme|ème)?\s*canton.*$",
    r"[\s-]+(?:nord|sud|est|ouest)(?:[\s-]+(?:nord|sud|est|ouest))*$",
    r"\(.*?\)",
    r"\b(cedex|arrondissement)\b.*$",
)
DISTRICT_NUMBER = r"\s+\d{1,2}\s*(?:e|er|eme|ème)?\s*$"

# Default city reference, columns city, department code, region, latitude, longitude.
CITY_CSV = """\
Paris,75,Île-de-France,48.8566,2.3522
La Défense,92,Île-de-France,48.8918,2.2362
Puteaux,92,Île-de-France,48.8848,2.2389
Courbevoie,92,Île-de-France,48.8973,2.2522
Nanterre,92,Île-de-France,48.8924,2.2071
Boulogne-Billancourt,92,Île-de-France,48.8397,2.2399
Issy-les-Moulineaux,92,Île-de-France,48.8245,2.2737
Levallois-Perret,92,Île-de-France,48.8950,2.2875
Neuilly-sur-Seine,92,Île-de-France,48.8846,2.2697
Rueil-Malmaison,92,Île-de-France,48.8778,2.1803
Saint-Denis,93,Île-de-France,48.9362,2.3574
Montreuil,93,Île-de-France,48.8638,2.4485
Massy,91,Île-de-France,48.7309,2.2713
Évry-Courcouronnes,91,Île-de-France,48.6290,2.4410
Saclay,91,Île-de-France,48.7311,2.1690
Versailles,78,Île-de-France,48.8049,2.1204
Guyancourt,78,Île-de-France,48.7733,2.0739
Créteil,94,Île-de-France,48.7904,2.4556
Ivry-sur-Seine,94,Île-de-France,48.8157,2.3849
Cergy,95,Île-de-France,49.0364,2.0761
Lyon,69,Auvergne-Rhône-Alpes,45.7640,4.8357
Villeurbanne,69,Auvergne-Rhône-Alpes,45.7719,4.8902
Grenoble,38,Auvergne-Rhône-Alpes,45.1885,5.7245
Clermont-Ferrand,63,Auvergne-Rhône-Alpes,45.7772,3.0870
Saint-Étienne,42,Auvergne-Rhône-Alpes,45.4397,4.3872
Annecy,74,Auvergne-Rhône-Alpes,45.8992,6.1294
Marseille,13,Provence-Alpes-Côte d'Azur,43.2965,5.3698
Aix-en-Provence,13,Provence-Alpes-Côte d'Azur,43.5297,5.4474
Nice,06,Provence-Alpes-Côte d'Azur,43.7102,7.2620
Sophia Antipolis,06,Provence-Alpes-Côte d'Azur,43.6163,7.0552
Toulon,83,Provence-Alpes-Côte d'Azur,43.1242,5.9280
Toulouse,31,Occitanie,43.6047,1.4442
Montpellier,34,Occitanie,43.6108,3.8767
Bordeaux,33,Nouvelle-Aquitaine,44.8378,-0.5792
Mérignac,33,Nouvelle-Aquitaine,44.8386,-0.6436
Poitiers,86,Nouvelle-Aquitaine,46.5802,0.3404
Limoges,87,Nouvelle-Aquitaine,45.8336,1.2611
Nantes,44,Pays de la Loire,47.2184,-1.5536
Angers,49,Pays de la Loire,47.4784,-0.5632
Le Mans,72,Pays de la Loire,48.0061,0.1996
Rennes,35,Bretagne,48.1173,-1.6778
Brest,29,Bretagne,48.3904,-4.4861
Lille,59,Hauts-de-France,50.6292,3.0573
Amiens,80,Hauts-de-France,49.8941,2.2958
Strasbourg,67,Grand Est,48.5734,7.7521
Reims,51,Grand Est,49.2583,4.0317
Metz,57,Grand Est,49.1193,6.1757
Nancy,54,Grand Est,48.6921,6.1844
Mulhouse,68,Grand Est,47.7508,7.3359
Dijon,21,Bourgogne-Franche-Comté,47.3220,5.0415
Besançon,25,Bourgogne-Franche-Comté,47.2378,6.0241
Rouen,76,Normandie,49.4432,1.0999
Caen,14,Normandie,49.1829,-0.3707
Le Havre,76,Normandie,49.4944,0.1079
Tours,37,Centre-Val de Loire,47.3941,0.6848
Orléans,45,Centre-Val de Loire,47.9030,1.9093
Ajaccio,2A,Corse,41.9192,8.7386
"""
