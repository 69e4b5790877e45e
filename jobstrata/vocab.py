"""Word lists, patterns, bounds and formats that results depend on."""

# The three domains a posting can belong to.
DOMAINS = ["data_engineer", "data_analytics", "digital_analytics"]

# Technology keywords looked for in descriptions.
TECH_KEYWORDS = [
    "python", "pyspark", "spark", "sql", "aws", "gcp", "azure",
    "kafka", "airflow", "dbt", "snowflake", "databricks", "hadoop",
    "scala", "java", "r", "tensorflow", "pytorch", "pandas",
]

# Cities per tier, lower case.
TIER_1_CITIES = ["são paulo", "rio de janeiro", "belo horizonte"]
TIER_2_CITIES = ["brasília", "curitiba", "porto alegre"]

# Parts of a city text that mark a Brazilian posting.
BRAZIL_CITY_PARTS = [
    "brazil", "brasil", "paulo", "rio", "belo", "brasilia",
    "curitiba", "porto alegre", "salvador", "fortaleza", "recife",
]

# Title terms that make a posting relevant to its category.
RELEVANT_TERMS = {
    "data_engineer": [
        "engineer", "engenheiro", "developer", "desenvolvedor", "data", "dados",
        "software", "backend", "python", "java", "scala",
    ],
    "data_analytics": [
        "analyst", "analista", "analytics", "data", "dados", "business",
        "reporting", "insights", "bi",
    ],
    "digital_analytics": [
        "analytics", "analista", "digital", "web", "marketing", "data", "dados",
        "metrics", "tracking",
    ],
}

# Seniority words, checked from the top level down.
SENIORITY_WORDS = {
    "Principal": ["principal", "architect", "head", "director"],
    "Senior": ["senior", "sênior", "sr", "iii", "lead"],
    "Pleno": ["pleno", "mid", "ii"],
    "Junior": ["junior", "júnior", "jr", "trainee", "entry"],
}
# The same levels as substrings, without accented spellings.
SENIORITY_SUBSTRINGS = {
    "Principal": "principal|architect|head|director",
    "Senior": r"senior|sr\.|iii|lead",
    "Pleno": "pleno|mid|ii",
    "Junior": r"junior|jr\.|trainee|entry",
}

# Contract words in a title, first match wins.
CONTRACT_WORDS = {
    "Estágio": ["estagiário", "estágio", "intern"],
    "Júnior": ["junior", "júnior", "trainee"],
    "Sênior": ["senior", "sênior", "sr."],
    "Pleno": ["pleno", "mid"],
    "Freelance": ["freelanc", "freela"],
}

# Job type patterns, first match wins.
JOB_TYPE_PATTERNS = {
    "CLT": "full.?time|integral|clt",
    "Meio período": "part.?time|meio.?periodo",
    "Temporário": "contract|temporario|freelance",
    "Remoto": "remote|remoto",
    "Híbrido": "hybrid|hibrido",
}
JOB_TYPE_MISSING = "Não informado"

# Work modality words, first match wins.
MODALITY_WORDS = {
    "Remoto": ["remot", "home office"],
    "Híbrido": ["híbrid", "hybrid"],
    "Presencial": ["presencial", "on-site"],
}

# Company suffixes dropped when names are normalised.
COMPANY_SUFFIXES = ["ltda", "lt", "sa", r"s\.a", "inc", "corp", "corporation"]

# Words that raise the priority of an alert.
HIGH_PRIORITY_WORDS = ["senior", "sênior", "lead"]

# Bounds of rules.
PREMIUM_SALARY = 8000
RECENT_DAYS = 30
LISTING_RECENT_DAYS = 7
LONG_DESCRIPTION = 500
MEDIUM_DESCRIPTION = 200
SNIPPET_CHARS = 200
PAYLOAD_SNIPPET_CHARS = 500
STALE_HOURS = 24
FEED_LOOKBACK_HOURS = 6
WATERMARK = "2 days"
MAX_FILES_PER_TRIGGER = 1000
STREAM_TRIGGER = "30 seconds"

# Quality thresholds per layer.
LAYER_THRESHOLDS = {
    "bronze": {"max_null_ratio": 0.05, "max_duplicate_ratio": 0.10},
    "silver": {"max_null_ratio": 0.02, "min_completeness": 0.95},
}

# Recommendation for an error message that contains all of the parts.
ERROR_RECOMMENDATIONS = [
    (["QUOTA_EXCEEDED"], "sequential_execution"),
    (["Volume", "not found"], "recreate_volumes"),
    (["DATASET_NOT_DEFINED"], "refresh_schema"),
]

# Notification text, filled by printf-style formatting.
NOTIFICATION_FORMAT = (
    "*Nova vaga disponível!*\n"
    "ID: `%1$s`\n"
    "Título: %2$s\n"
    "Empresa: %3$s\n"
    "Modalidade: %4$s\n"
    "Publicada em: %5$s\n"
    "[Abrir vaga](%6$s)\n\n"
    "Você se candidatou? Responda aqui com:\n"
    "SIM %1$s ou NAO %1$s."
)
NUMBERED_NOTIFICATION_FORMAT = (
    "*🆕 Nova Vaga %1$d/%2$d*\n\n"
    "*Domínio:* %3$s\n"
    "*Título:* %4$s\n"
    "*Empresa:* %5$s\n"
    "*Modalidade:* %6$s\n"
    "*ID:* `%7$s...`\n"
    "[🔗 Ver vaga](%8$s)\n"
)
ALERT_FORMAT = "🚨 Nova vaga detectada: %s - %s"
