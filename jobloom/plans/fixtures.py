"""Literal dictionaries and lists the catalogue uses on the test tables."""

from __future__ import annotations

import json

AS_OF = "2001-08-01"

TITLES = [
    None, "Senior Data Engineer", "Full Stack Developer", "DBA lead", "Store Keeper", "Programmer",
    "Engineer", "HR analyst", "Talent analyst", "Data person", "QA Engineer II", "iOS Developer",
    "Frontend architect", "Backend software engineer", "Business Analyst", "Accountant", "",
]

VOCAB = [
    "react", "javascript", "css", "python", "sql", "kafka", "hibernate", "recruitment", "payroll",
    "machine learning", "pandas", "tensorflow", "etl", "kotlin", "communication", "docker", "figma",
    "jira", "basket weaving", "html", "java", "spring", "typescript",
]

# (skill, bucket, precedence); python and docker are listed twice, the first bucket wins.
TAXONOMY = (
    [(s, "technical", 0) for s in VOCAB if s not in ("communication", "jira", "basket weaving")]
    + [("jira", "tools", 1), ("python", "tools", 1), ("docker", "tools", 1)]
    + [("communication", "soft", 2)]
)

# Invented lists with what the rules need: a skill listed twice, two lists that are the same,
# a list per gate, and skills that two lists share.
ROLE_SKILLS = {
    "Data Scientist / ML Engineer": ["machine learning", "pandas", "tensorflow", "model review"],
    "Backend Developer": ["hibernate", "Spring", "java", "python", "message queues", "hibernate"],
    "Frontend Developer": ["css", "html", "react", "javascript", "typescript", "page layout"],
    "Fullstack Developer": ["react", "javascript", "sql", "release work"],
    "Data Engineer": ["kafka", "etl", "sql", "warehouse loads"],
    "Mobile Developer": ["kotlin", "phone apps"],
    "Database Engineer / DBA": ["sql", "index tuning", "backups"],
    "HR Manager": ["payroll", "recruitment", "onboarding"],
    "HR / Talent Acquisition": ["payroll", "recruitment", "onboarding"],
}

ROLE_ROWS = [(r, i, s) for i, (r, skills) in enumerate(ROLE_SKILLS.items()) for s in skills]

BUCKET_TEXTS = [
    ("technical", 0, json.dumps(["React ", "javascript", "CSS", "python", "sql", "\tetl"])),
    ("tools", 1, json.dumps(["jira", "python", "Docker"])),
    ("soft", 2, json.dumps(["communication", "jira"])),
]

BUCKET_ROWS = [
    (skill.strip().lower(), bucket, precedence)
    for bucket, precedence, listed in BUCKET_TEXTS
    for skill in json.loads(listed)
]


def sql_text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_rows(rows) -> str:
    return ", ".join("(" + ", ".join(sql_text(v) for v in row) + ")" for row in rows)


def sql_in(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"
