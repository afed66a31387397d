"""Names, tables, texts and formats that results must carry exactly.

Nothing here is computed. Measurement data, people and users are inputs and
are never kept in this file.
"""

# Sheet of the workbook -> landing file.
SHEET_FILES = {
    "Prechancado": "Prechancado.csv",
    "2° y 3°": "2_y_3.csv",
    "Terciario": "Terciario.csv",
    "Cuaternario": "Cuaternario.csv",
    "Molienda Sag": "Molienda_Sag.csv",
    "Molienda Convencional": "Molienda_Convencional.csv",
    "CDM (1)": "CDM_(1).csv",
    "CDM (2)": "CDM_(2).csv",
    "Nodo": "Nodo.csv",
}

# Landing table -> file. The last two are summaries and feed no model.
LANDING_FILES = {
    "mediciones_prechancado": "Prechancado.csv",
    "mediciones_chancado_2_3": "2_y_3.csv",
    "mediciones_terciario": "Terciario.csv",
    "mediciones_cuaternario": "Cuaternario.csv",
    "mediciones_molienda_sag": "Molienda_Sag.csv",
    "mediciones_molienda_convencional": "Molienda_Convencional.csv",
    "mediciones_cdm_1": "CDM_(1).csv",
    "mediciones_cdm_2": "CDM_(2).csv",
    "mediciones_nodo": "Nodo.csv",
    "resumen_concentraciones": "Resumen.csv",
    "datos_consolidados": "Datos.csv",
}

# Landing table of a measurement sheet -> plant. Two sheets share CDM.
SOURCE_PLANT = {
    "mediciones_prechancado": "Pre-Chancado",
    "mediciones_chancado_2_3": "Chancado 2° y 3°",
    "mediciones_terciario": "Chancado Fino 3°",
    "mediciones_cuaternario": "Chancado Fino 4°",
    "mediciones_molienda_sag": "Molienda SAG",
    "mediciones_molienda_convencional": "Molienda Convencional",
    "mediciones_cdm_1": "CDM",
    "mediciones_cdm_2": "CDM",
    "mediciones_nodo": "Nodo 3500",
}

# Snapshot table names are the landing names with this prefix.
SNAPSHOT_PREFIX = "snap_"

# Labels of a sheet.
WEEK_LABELS = ("Semanas", "Semana")
NON_POINT_LABELS = ("Semanas", "Semana", "Lugar Monitoreo")
NON_POINT_PATTERNS = ("%Operador%", "%Tecnico%", "%Técnico%", "Hora%", "Fecha%")
DATE_PATTERN = "Fecha%"
OPERATOR_PATTERN = "%Operador%"
TECHNICIAN_PATTERNS = ("%Tecnico%", "%Técnico%")
START_LABEL = "Hora inicio"
END_LABEL = "Hora termino"
CONCENTRATION_UPPER_BOUND = 100.0
BASE_YEAR = 2025
WEEKS_IN_FIRST_YEAR = 52

# Bands: level, from (included), to (excluded, None is open), colour, label, over the internal limit.
BANDS = (
    (1, 0.00, 0.25, "azul", "bajo", False),
    (2, 0.25, 0.50, "verde", "controlado", False),
    (3, 0.50, 2.50, "amarillo", "alerta", False),
    (4, 2.50, 5.00, "rojo", "peligroso", True),
    (5, 5.00, None, "negro", "critico", True),
)

# Governance dimensions.
PLANTS = (
    "Pre-Chancado",
    "Nodo 3500",
    "Chancado 2° y 3°",
    "Chancado Fino 3°",
    "Chancado Fino 4°",
    "Molienda SAG",
    "Molienda Convencional",
    "CDM",
)
GROUPS = {
    "planta": {
        "Plantas de chancado": (
            "Pre-Chancado",
            "Nodo 3500",
            "Chancado 2° y 3°",
            "Chancado Fino 3°",
            "Chancado Fino 4°",
        ),
        "Plantas de molienda": ("Molienda SAG", "Molienda Convencional", "CDM"),
        "Todas las plantas": PLANTS,
    },
    "ambito": {"Todos": ("Seguridad ocupacional", "Medioambiente")},
}
CLEARANCES = ("Público", "Interno", "Restringido", "Solo gerencias")
CONTEXT_LEVELS = ("ambito", "planta")
PAIR_SEPARATOR = "_._"
VALUE_SEPARATOR = ":::"

EMBEDDING_SIZE = 384
TOP_K = 10
MEMORY_TURNS = 5
NO_EXPIRY = -1
CONTEXT_MARK = "[CONTEXTO]"
NO_RULE = "(sin regla)"

# Text of a chunk, one per rule.
TEMPLATES = {
    "P00001_M00001": (
        'Planta {{ planta }} — punto de medición "{{ punto_evaluacion }}", semana {{ semana }} de {{ anio }}: '
        "concentración de polvo respirable {{ concentracion_mg_m3 }} mg/m³, semáforo {{ etiqueta_semaforo }} "
        "({{ veces_sobre_limite }}x el límite interno de {{ limite_interno_mg_m3 }} mg/m³). "
        "Medición realizada entre {{ hora_inicio }} y {{ hora_termino }}. "
        "Operador de planta: {{ operador }}. Técnico en higiene: {{ tecnico }}."
    ),
    "P00002_M00002": (
        "Resumen anual de polvo respirable — planta {{ planta }}, año {{ anio }}: "
        "{{ semanas_medidas }} {{ semanas_label }} en {{ puntos_medidos }} {{ puntos_label }} de control. "
        "Concentración promedio {{ concentracion_promedio_mg_m3 }} mg/m³, máxima {{ concentracion_max_mg_m3 }} mg/m³, "
        "mínima {{ concentracion_min_mg_m3 }} mg/m³. {{ registros_sobre_limite }} de {{ total_registros }} registros "
        "({{ pct_sobre_limite }}%) superaron el límite interno de {{ limite_interno_mg_m3 }} mg/m³."
    ),
    "P00003_M00003": (
        "Concentración histórica máxima en planta {{ planta }}: {{ concentracion_mg_m3 }} mg/m³ "
        'en punto "{{ punto_evaluacion }}", semana {{ semana }} de {{ anio }} (fecha: {{ fecha }}), '
        "semáforo {{ etiqueta_semaforo }}, equivalente a {{ veces_sobre_limite }}x el límite interno de "
        "{{ limite_interno_mg_m3 }} mg/m³. Medición de {{ hora_inicio }} a {{ hora_termino }}. "
        "Operador de planta: {{ operador }} (RUN {{ operador_dni }}). "
        "Técnico en higiene: {{ tecnico }} (RUN {{ tecnico_dni }})."
    ),
    "P00004_M00004": (
        'Planta {{ planta }} — punto de medición "{{ punto_evaluacion }}", última jornada '
        "(semana {{ semana }} de {{ anio }}): concentración {{ concentracion_mg_m3 }} mg/m³, "
        "semáforo {{ etiqueta_semaforo }} ({{ veces_sobre_limite }}x el límite interno de "
        "{{ limite_interno_mg_m3 }} mg/m³). Medición de {{ hora_inicio }} y {{ hora_termino }}. "
        "Operador: {{ operador }}. Técnico en higiene: {{ tecnico }}."
    ),
}
