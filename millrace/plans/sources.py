"""Cleaning and validation settings of the three sources."""

from __future__ import annotations

# The published column names and strategies per source.
JOBS_CLEANING = {
    "text_columns": ["Empresa", "Ciudad", "País", "Cargo"],
    "numeric_columns": ["Salario_Anual_USD"],
    "date_columns": ["Fecha_Publicación"],
    "missing_strategy": {"Ciudad": "unknown", "País": "unknown", "Salario_Anual_USD": "median"},
}
INVESTMENTS_CLEANING = {
    "text_columns": ["Organización", "Área_Tecnológica", "Ciudad", "País"],
    "numeric_columns": ["Inversión_USD", "Participantes", "Satisfacción_Promedio"],
    "missing_strategy": {"Ciudad": "unknown", "País": "unknown", "Inversión_USD": "median"},
}
PROFILES_CLEANING = {
    "text_columns": [
        "Ciudad", "País", "Lenguajes_Dominio", "Frameworks_Dominio", "Certificaciones", "Nivel_Educativo",
        "Área_Trabajo_Actual",
    ],
    "numeric_columns": ["Edad", "Años_Experiencia", "Salario_Actual_USD"],
    "missing_strategy": {
        "Ciudad": "unknown",
        "País": "unknown",
        "Certificaciones": "unknown",
        "Años_Experiencia": "median",
        "Salario_Actual_USD": "median",
    },
}
JOBS_RULES = {"salary_positive": {"type": "range", "column": "salario_anual_usd", "min": 0, "max": 500_000}}
PROFILES_RULES = {
    "age_realistic": {"type": "range", "column": "edad", "min": 18, "max": 70},
    "experience_realistic": {"type": "range", "column": "años_experiencia", "min": 0, "max": 40},
}
SOURCE_TAGS = {"jobs": "empleos", "investment": "inversiones", "profiles": "perfiles"}
