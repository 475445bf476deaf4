"""Word lists and rules the results depend on."""

# First key contained in the lower-cased title wins.
TITLE_RULES = (
    ("data engineer", "Data Engineer"),
    ("business analyst", "Business Analyst"),
    ("android developer", "Mobile Developer"),
    ("ios developer", "Mobile Developer"),
    ("frontend developer", "Frontend Developer"),
    ("backend developer", "Backend Developer"),
    ("full stack developer", "Fullstack Developer"),
    ("fullstack developer", "Fullstack Developer"),
    ("devops engineer", "DevOps Engineer"),
    ("qa engineer", "QA / Test Engineer"),
    ("test engineer", "QA / Test Engineer"),
    ("database administrator", "Database Engineer / DBA"),
    ("dba", "Database Engineer / DBA"),
)

HARD_TECH = (
    "java", "python", "javascript", "typescript", "c++", "c#", "go", "ruby", "kotlin", "swift",
    "react", "angular", "vue", "node", "node.js", "spring", "django", "flask", "express",
    "hibernate", "spark", "pyspark", "hadoop", "airflow", "kafka", "snowflake", "databricks",
    "bigquery", "redshift", "docker", "kubernetes", "terraform", "ansible", "jenkins", "sql",
    "postgresql", "mysql", "mongodb", "oracle", "aws", "azure", "gcp", "cloud",
)

ENGINEERING_TITLE = "engineer|developer|analyst|architect|data|software|tech"

ML_CORE = ("machine learning", "ml", "deep learning", "tensorflow", "pytorch", "nlp", "ai")

DATA_CORE = (
    "sql", "spark", "pyspark", "etl", "data pipeline", "airflow", "kafka", "snowflake",
    "databricks",
)

DATA_FALLBACK = (
    "sql", "spark", "pyspark", "etl", "data pipeline", "warehouse", "airflow", "kafka",
    "snowflake",
)

BACKEND_INDICATORS = (
    "java", "spring", ".net", "python", "node.js", "django", "flask", "express", "hibernate",
)

CATEGORIES = ("technical", "tools", "soft")

# Sources run in each cycle.
CYCLE_SOURCES = {
    "MORNING": ("foundit", "naukri"),
    "AFTERNOON": ("foundit", "naukri"),
    "NIGHT": ("foundit", "naukri", "instahyre"),
}

# Local hour at which each cycle starts.
CYCLE_HOURS = {"MORNING": 0, "AFTERNOON": 6, "NIGHT": 13}

CYCLE_ZONE = "Asia/Kolkata"

GRAPH_EXPIRY_DAYS = 21
JOB_EXPIRY_DAYS = 90
INTERNSHIP_EXPIRY_DAYS = 30

# Last rank of each demand tier; everything later is "low".
DEMAND_TIERS = (("critical", 20), ("high", 50), ("medium", 100))
