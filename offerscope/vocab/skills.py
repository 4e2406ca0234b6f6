"""Skill dictionary: the default configuration of the skill extractor.

Each entry is ``Skill(name, category, kind, patterns, case_sensitive)``. Patterns carry no word
boundaries; the extractor adds them. Replace the list to track another vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Skill:
    name: str
    category: str
    kind: str
    patterns: tuple[str, ...]
    case_sensitive: bool = False


def _s(name: str, category: str, kind: str, *patterns: str, case_sensitive: bool = False) -> Skill:
    return Skill(name, category, kind, patterns, case_sensitive)


# Names, categories, kinds and patterns of the default dictionary.
DEFAULT_SKILLS: tuple[Skill, ...] = (
    _s("Python", "Langages", "tech", "python"),
    _s("SQL", "Langages", "tech", "sql", "t-sql", "pl/sql", "plsql"),
    _s("R", "Langages", "tech", "R(?!&D| ?& ?D)", "RStudio", "langage R", case_sensitive=True),
    _s("Scala", "Langages", "tech", "scala"),
    _s("Java", "Langages", "tech", "java(?!script)"),
    _s("SAS", "Langages", "tech", "SAS", case_sensitive=True),
    _s("VBA", "Langages", "tech", "vba"),
    _s("JavaScript", "Langages", "tech", "javascript", "typescript"),
    _s("PostgreSQL", "Bases de données", "tech", "postgres(?:ql)?"),
    _s("MySQL", "Bases de données", "tech", "mysql"),
    _s("Oracle", "Bases de données", "tech", "oracle"),
    _s("SQL Server", "Bases de données", "tech", "sql server", "mssql"),
    _s("MongoDB", "Bases de données", "tech", "mongo(?:db)?"),
    _s("Elasticsearch", "Bases de données", "tech", "elastic ?search"),
    _s("Snowflake", "Bases de données", "tech", "snowflake"),
    _s("BigQuery", "Bases de données", "tech", "big ?query"),
    _s("Redshift", "Bases de données", "tech", "redshift"),
    _s("Tableau", "BI & Dataviz", "tech", "tableau(?! ?de ?bord)(?! croisé)(?!x)", "tableau software"),
    _s("Power BI", "BI & Dataviz", "tech", "power ?bi", "dax"),
    _s("Looker", "BI & Dataviz", "tech", "looker(?: studio)?", "data studio"),
    _s("Qlik", "BI & Dataviz", "tech", "qlik(?: ?sense| ?view)?"),
    _s("Excel", "BI & Dataviz", "tech", "excel"),
    _s("Matplotlib/Seaborn", "BI & Dataviz", "tech", "matplotlib", "seaborn", "plotly"),
    _s("Streamlit/Dash", "BI & Dataviz", "tech", "streamlit", "dash"),
    _s("Pandas/NumPy", "Data engineering", "tech", "pandas", "numpy"),
    _s("Spark", "Data engineering", "tech", "spark", "pyspark"),
    _s("Hadoop", "Data engineering", "tech", "hadoop", "hive", "hdfs"),
    _s("Airflow", "Data engineering", "tech", "airflow"),
    _s("dbt", "Data engineering", "tech", "dbt"),
    _s("Kafka", "Data engineering", "tech", "kafka"),
    _s("Databricks", "Data engineering", "tech", "databricks"),
    _s("ETL/ELT", "Data engineering", "skill", "etl", "elt", "pipelines? de données", "data pipelines?"),
    _s("Talend", "Data engineering", "tech", "talend"),
    _s("Web scraping", "Data engineering", "skill", "web ?scraping", "scrapy", "beautiful ?soup", "selenium"),
    _s("AWS", "Cloud", "tech", "aws", "amazon web services", "s3", "sagemaker"),
    _s("Azure", "Cloud", "tech", "azure"),
    _s("GCP", "Cloud", "tech", "gcp", "google cloud"),
    _s("Git", "MLOps & DevOps", "tech", "git", "github", "gitlab"),
    _s("Docker", "MLOps & DevOps", "tech", "docker"),
    _s("Kubernetes", "MLOps & DevOps", "tech", "kubernetes", "k8s"),
    _s("MLflow", "MLOps & DevOps", "tech", "mlflow"),
    _s("CI/CD", "MLOps & DevOps", "skill", "ci ?/ ?cd", "intégration continue"),
    _s("API REST", "MLOps & DevOps", "tech", "api rest", "rest api", "fastapi", "flask"),
    _s("Linux", "MLOps & DevOps", "tech", "linux", "bash"),
    _s("Machine Learning", "ML & IA", "skill", "machine learning", "apprentissage automatique", "ml"),
    _s("Deep Learning", "ML & IA", "skill", "deep learning", "apprentissage profond", "réseaux de neurones"),
    _s("Scikit-learn", "ML & IA", "tech", "scikit[- ]learn", "sklearn"),
    _s("TensorFlow", "ML & IA", "tech", "tensorflow", "keras"),
    _s("PyTorch", "ML & IA", "tech", "pytorch", "torch"),
    _s("NLP", "ML & IA", "skill", "nlp", "traitement (?:automatique )?du langage", "natural language processing"),
    _s("Computer Vision", "ML & IA", "skill", "computer vision", "vision par ordinateur"),
    _s("Statistiques", "ML & IA", "skill", "statistiques?", "statistics", "économétrie"),
    _s("Séries temporelles", "ML & IA", "skill", "séries temporelles", "time series", "forecasting", "prévision"),
    _s("IA générative", "IA générative", "skill", "ia générative", "genai", "generative ai", "gen ai"),
    _s("LLM", "IA générative", "tech", "llms?", "large language models?", "gpt", "mistral", "openai"),
    _s("RAG", "IA générative", "skill", "rag", "retrieval[- ]augmented"),
    _s("LangChain", "IA générative", "tech", "langchain", "llamaindex"),
    _s("Hugging Face", "IA générative", "tech", "hugging ?face", "transformers"),
    _s("Data gouvernance", "Méthodes & gouvernance", "skill",
       "gouvernance (?:des )?données", "data governance", "qualité des données", "data quality"),
    _s("RGPD", "Méthodes & gouvernance", "skill", "rgpd", "gdpr"),
    _s("Agile/Scrum", "Méthodes & gouvernance", "skill", "agile", "scrum", "kanban"),
    _s("Modélisation de données", "Méthodes & gouvernance", "skill",
       "modélisation (?:de |des )?données", "data modeling", "data warehouse", "entrepôt de données",
       "schéma en étoile"),
    _s("A/B testing", "Méthodes & gouvernance", "skill", "a/b ?test(?:ing)?", "ab test(?:ing)?"),
    _s("KPI & reporting", "Méthodes & gouvernance", "skill",
       "kpis?", "reporting", "tableaux? de bord", "dashboards?"),
    _s("Communication", "Soft skills", "skill", "communication", "vulgariser", "vulgarisation", "storytelling"),
    _s("Esprit d'analyse", "Soft skills", "skill", "esprit d'analyse", "esprit analytique", "analytical"),
    _s("Autonomie", "Soft skills", "skill", "autonomie", "autonome"),
    _s("Travail en équipe", "Soft skills", "skill", "travail en équipe", "esprit d'équipe", "teamwork"),
    _s("Anglais", "Soft skills", "skill", "anglais", "english"),
    _s("Gestion de projet", "Soft skills", "skill",
       "gestion de projets?", "project management", "pilotage de projets?"),
    _s("Relation client", "Soft skills", "skill",
       "relation client", "sens du client", "client-facing", "parties prenantes", "stakeholders?"),
)
