"""Label vocabularies. Every pattern runs on normalised text (see ``functions.text.norm``)."""

from __future__ import annotations

# Sentinels counted as groups by every view.
UNKNOWN = "Non précisé"
OTHER_ROLE = "Autre métier data"
OTHER_SECTOR = "Autre / Non précisé"
ALL_ROLES = "Tous métiers"

# Seniority labels with their display order, and the cue of each label.
SENIORITY_ORDER = {"Stage / Alternance": 1, "Junior": 2, "Confirmé": 3, "Senior": 4, UNKNOWN: 5}
INTERN = "Stage / Alternance"
INTERN_TITLE = r"\bstage\b|stagiaire|intern(ship)?\b|alternan|apprenti"
SENIORITY_TITLE_RULES = (
    ("Senior", r"\bsenior\b|\bsr\b|\blead\b|principal|\bexpert\b|head of|\bstaff\b|tech lead"),
    ("Junior", r"\bjunior\b|\bjr\b|debutant|jeune diplome|graduate"),
    ("Confirmé", r"confirme|experimente|medior|intermediate"),
)

# Experience wording.
BEGINNER = r"debutant|jeune diplome|sans experience|graduate|entry level"
YEARS_OF_EXPERIENCE = r"(\d+(?:[.,]\d+)?)\s*(?:an\(s\)|ans?\b|years?)"
MONTHS_OF_EXPERIENCE = r"(\d+)\s*mois"

# Role families, first match wins.
ROLE_RULES = (
    ("AI / LLM Engineer",
     r"\bllm\b|ia generative|genai|generative ai|\bai engineer\b|\bia engineer\b|ingenieur ia\b|developpeur ia\b"
     r"|ingenieur nlp|prompt engineer"
     r"|(?:ingenieur|engineer|developpeur)[^|]{0,40}(?:intelligence artificielle|\bia\b|\bai\b)"),
    ("Machine Learning Engineer",
     r"machine learning engineer|\bml engineer|mlops|ml ops|ingenieur machine learning|ingenieur ml\b"),
    ("Data Scientist",
     r"data scien|statisticien|scientifique des donnees|machine learning|\bml\b|deep learning"),
    ("Data Engineer",
     r"data engineer|ingenieur (?:de )?donnees|ingenieur data|big data|data architect"
     r"|architecte (?:data|donnees)|developpeur (?:big )?data|\betl\b|data[^|]{0,25}\bengineer\b"),
    ("Analytics Engineer / BI",
     r"analytics engineer|bi engineer|developpeur bi|ingenieur decisionnel|consultant (?:bi|decisionnel)"
     r"|developpeur decisionnel"),
    ("Recherche / R&D IA",
     r"chercheu|research|\bphd\b|\bthese\b|doctora|\br&d\b|\br et d\b"),
    ("Consultant Data & IA", r"consultant"),
    ("Data Manager / Gouvernance",
     r"data steward|data manager|gouvernance|data quality|qualite des donnees|data owner|data governance"),
    ("Chef de projet / Lead Data & IA",
     r"(?:chef de projet|project manager|responsable|head of|directeur|director|lead|manager|product owner|chief"
     r"|charge de mission)[^|]{0,60}(?:\bdata\b|donnees|intelligence artificielle|\bia\b|\bai\b)"),
    ("Data Analyst",
     r"analyst|analyste|business intelligence|\bbi\b|decisionnel|reporting|data visuali[sz]"),
)

# Scope of the market; the exclusion wins over the inclusion.
SCOPE_INCLUDED = (
    r"\bdata\b|donnee|intelligence artificielle|\bia\b|\bai\b|\ba\.i\b|\bml\b|machine learning|deep learning"
    r"|\bnlp\b|\bllm\b|\bbi\b|business intelligence|analytics|decisionnel|statisticien|mlops|big data|datascientist")
SCOPE_EXCLUDED = (
    r"professeur|enseignant|formateur|teacher|commercial|business developer|account executive|\bsales\b"
    r"|recruteur|recrutement")

# Remote policy, in order ("pas de télétravail" must reach the on-site rule before the hybrid one).
REMOTE_RULES = (
    ("Full remote",
     r"full ?remote|100 ?% (?:en )?(?:teletravail|remote)|teletravail (?:total|complet|integral)"
     r"|remote first|entierement a distance|telecommute"),
    ("Sur site",
     r"pas de teletravail|sans teletravail|aucun teletravail|100 ?% (?:sur site|presentiel)"
     r"|teletravail non (?:possible|autorise)|no remote|on[- ]site only"),
    ("Hybride", r"teletravail|hybride|hybrid|remote|travail a distance"),
)
REMOTE_POSSIBLE = ("Hybride", "Full remote")
JUNIOR_LEVELS = ("Junior", "Stage / Alternance")

# Contract rules as (label, pattern on the contract text, pattern on the title or None).
CONTRACT_RULES = (
    ("Alternance", r"alternan|apprenti|contrat pro", r"alternan|apprenti"),
    ("Stage", r"\bstage\b|intern", r"\bstage\b|stagiaire|intern(ship)?\b"),
    ("Freelance", r"freelance|independant|portage|contractor|\blib\b|liberal|\bmission\b", None),
    ("Intérim / temporaire", r"interim|\bmis\b|travail temporaire|temporary|\bsai\b|saisonnier", None),
    ("CDD", r"\bcdd\b|duree determinee|\bcontract\b", None),
    ("CDI", r"\bcdi\b|duree indeterminee|permanent|full_time|full time", None),
)
INTERN_CONTRACTS = ("Stage", "Alternance")
PERMANENT = "CDI"

# Sectors, first match wins.
SECTOR_RULES = (
    ("Recrutement / Intérim",
     r"interim|recrutement|travail temporaire|agence d'emploi|recruitment|staffing"),
    ("Banque / Assurance / Finance",
     r"banque|bancaire|assurance|financ|credit|mutuelle|accounting|bourse|fintech"),
    ("Énergie / Utilities",
     r"energie|electricite|\bgaz\b|petrol|nucleaire|energy|eau et assainissement"),
    ("Santé / Pharma", r"pharma|sante|hospital|hopital|medical|medtech|healthcare|biotech"),
    ("Industrie / Aéronautique",
     r"industrie|manufactur|aeronaut|automobile|chimi|fabrication|btp|construction|metallurg|engineering"),
    ("Retail / E-commerce",
     r"commerce|retail|grande distribution|e-commerce|grande consommation|luxe|\bmode\b|sales jobs"),
    ("Télécoms / Médias",
     r"telecom|media|edition de journaux|audiovisuel|publicite|marketing"),
    ("Transport / Logistique", r"transport|logisti|ferroviaire|aerien|maritime"),
    ("Secteur public / Éducation",
     r"administration|public|collectivite|enseignement|education|universit|recherche"),
    ("Tech / Éditeur de logiciels",
     r"edition de logiciel|saas|software|startup|scale-up|internet|plateforme|jeux video"),
    ("Conseil / ESN",
     r"conseil|consult|\besn\b|ssii|informatique|programmation|it jobs|systemes et logiciels"
     r"|traitement de donnees|hebergement"),
)

# Labels of the exported views.
COUNTRY = "France"
SKILL_KIND_LABELS = {"tech": "Technologie", "skill": "Compétence / méthode"}
DATASET_LABELS = {"real": "Réel", "demo": "Démonstration (synthétique)"}
SELECTION_LABELS = {"real": "réel", "demo": "démo", "both": "réel + démo"}
CLOUD_SKILLS = ("AWS", "Azure", "GCP")
GENERATIVE_SKILLS = ("LLM", "IA générative", "RAG", "LangChain", "Hugging Face")
CAPITAL_REGION = "Île-de-France"
