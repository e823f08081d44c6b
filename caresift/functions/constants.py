"""Names, lists, weights, grids and wordings that results depend on."""

import numpy as np

# --- questionnaire columns (fixed values) -----------------------------------
FEATURE_COLUMNS = [
    "GENDER",
    "AGE",
    "SMOKING",
    "YELLOW FINGERS",
    "ANXIETY",
    "PEER PRESSURE",
    "CHRONIC DISEASE",
    "FATIGUE",
    "ALLERGY",
    "WHEEZING",
    "ALCOHOL CONSUMING",
    "COUGHING",
    "SHORTNESS OF BREATH",
    "SWALLOWING DIFFICULTY",
    "CHEST PAIN",
]
TARGET_COLUMN = "LUNG_CANCER"
GROUP_COLUMN = "GENDER"
TARGET_CODES = {"NO": 0, "YES": 1}
SPACED_NAMES = {
    "YELLOW_FINGERS": "YELLOW FINGERS",
    "PEER_PRESSURE": "PEER PRESSURE",
    "CHRONIC_DISEASE": "CHRONIC DISEASE",
    "ALCOHOL_CONSUMING": "ALCOHOL CONSUMING",
    "SHORTNESS_OF_BREATH": "SHORTNESS OF BREATH",
    "SWALLOWING_DIFFICULTY": "SWALLOWING DIFFICULTY",
    "CHEST_PAIN": "CHEST PAIN",
}

# --- image classes (fixed values) --------------------------------------------
IMAGE_CLASSES = [
    ("Normal cases", 0, "Normal"),
    ("Bengin cases", 0, "Benigno"),
    ("Malignant cases", 1, "Maligno"),
]
LABEL_NAMES = {0: "nao_maligno", 1: "maligno"}
LABEL_DISPLAY = {"nao_maligno": "Nao maligno", "maligno": "Maligno"}
IMAGE_EXTENSIONS = [".png", ".jpg", ".jpeg", ".bmp", ".tif", ".tiff"]
CSV_EXTENSIONS = [".csv"]

# --- decision values (fixed values) --------------------------------------------
DEFAULT_THRESHOLD = 0.5
DEFAULT_IMAGE_SIZE = 224
HIGH_RISK, MODERATE_RISK = 0.7, 0.4
RISK_WORDS = ["baixo", "moderado", "alto"]
EXPLAINED_ROWS = 5
TABULAR_WEIGHTS = {"recall": 0.6, "specificity": 0.2, "f1": 0.2, "gap": 0.5}
IMAGE_WEIGHTS = {"recall": 0.45, "specificity": 0.20, "f1": 0.20, "auc": 0.15}
REQUIRED_RECALL = 0.99

# --- threshold grids (fixed values, from their rules) ----------------------------
COARSE_GRID = [round(0.1 + 0.05 * i, 2) for i in range(17)]
FINE_GRID = np.linspace(0.1, 0.9, 81).tolist()
RECALL_GRID = np.linspace(0.15, 0.99, 99).tolist()

# --- search spaces and experiments (fixed values) ----------------------------------
FOREST_GENES = [
    ("n_estimators", "int", 50.0, 250.0, []),
    ("max_depth", "int", 3.0, 30.0, []),
    ("min_samples_split", "int", 2.0, 10.0, []),
    ("min_samples_leaf", "int", 1.0, 4.0, []),
    ("max_features", "float", 0.3, 1.0, []),
]
TABULAR_SPACES = {
    "RandomForestClassifier": FOREST_GENES,
    "LogisticRegression": [
        ("C", "float", 0.01, 10.0, []),
        ("penalty", "cat", 0.0, 0.0, ["l1", "l2"]),
        ("solver", "cat", 0.0, 0.0, ["liblinear", "saga"]),
        ("class_weight", "cat", 0.0, 0.0, ["none", "balanced"]),
        ("max_iter", "int", 200.0, 1000.0, []),
    ],
    "KNeighborsClassifier": [
        ("n_neighbors", "int", 3.0, 15.0, []),
        ("weights", "cat", 0.0, 0.0, ["uniform", "distance"]),
        ("p", "int", 1.0, 2.0, []),
    ],
    "ExtraTreesClassifier": FOREST_GENES,
}
IMAGE_SPACE = {
    "ImageHead": [
        ("learning_rate", "log_float", 5e-5, 5e-4, []),
        ("batch_size", "cat", 0.0, 0.0, ["8", "16"]),
        ("frozen_epochs", "int", 2.0, 4.0, []),
        ("fine_tune_epochs", "int", 1.0, 2.0, []),
        ("dense_units", "cat", 0.0, 0.0, ["64", "128", "256"]),
        ("dropout_rate", "float", 0.20, 0.50, []),
        ("use_class_weight", "cat", 0.0, 0.0, ["true", "false"]),
        ("unfreeze_layers", "cat", 0.0, 0.0, ["10", "20", "40"]),
    ]
}
TABULAR_EXPERIMENTS = [
    {"name": "exp1", "pop_size": 8, "generations": 3, "cx_prob": 0.8, "mut_prob": 0.1, "seed": 1},
    {"name": "exp2", "pop_size": 8, "generations": 3, "cx_prob": 0.8, "mut_prob": 0.3, "seed": 2},
    {"name": "exp3", "pop_size": 12, "generations": 3, "cx_prob": 0.8, "mut_prob": 0.1, "seed": 3},
]
IMAGE_EXPERIMENTS = [
    {"name": "exp1", "pop_size": 2, "generations": 1, "cx_prob": 0.8, "mut_prob": 0.15, "seed": 11},
    {"name": "exp2", "pop_size": 2, "generations": 1, "cx_prob": 0.8, "mut_prob": 0.30, "seed": 22},
    {"name": "exp3", "pop_size": 3, "generations": 2, "cx_prob": 0.8, "mut_prob": 0.20, "seed": 33},
]
PARAMETER_GRIDS = {
    "Regressão Logística": {"C": [0.1, 1.0, 10.0], "solver": ["liblinear"]},
    "KNN": {"n_neighbors": [3, 5, 7, 9], "weights": ["uniform", "distance"]},
    "Random Forest": {
        "n_estimators": [100, 200],
        "max_depth": ["none", "10"],
        "min_samples_split": [2, 5],
    },
    "Extra Trees": {
        "n_estimators": [300, 700],
        "max_depth": ["none", "10"],
        "min_samples_leaf": [1, 2],
    },
}

# --- texts (fixed values) -------------------------------------------------------------
TABULAR_EXAM = "triagem tabular a partir de dados demográficos e sintomas informados pelo paciente"
IMAGE_EXAM = "análise de imagem de ressonância por visão computacional"
PROMPT_OPENING = (
    "\nVocê é uma LLM integrada a um sistema de apoio ao diagnóstico médico.\n\n"
    "Explique o resultado abaixo de forma clara, objetiva e responsável.\n\n"
    "Dados do modelo:\n- Modelo utilizado: "
)
PROMPT_SECTIONS = (
    "\n\nResponda obrigatoriamente neste formato:\n\n"
    "Resumo:\nRisco:\nJustificativa:\nRecomendação:\nObservação:\n\nRegras:\n"
    "- Não diga que o paciente tem diagnóstico confirmado.\n"
)
TABULAR_RULES = (
    "- Não substitua avaliação médica.\n"
    "- Use linguagem adequada para profissionais da saúde.\n"
    "- Seja objetivo.\n"
    "- A recomendação deve ser compatível com o nível de risco.\n"
    "- A observação deve deixar claro que o resultado é apoio à decisão clínica.\n"
    "- Não use markdown, negrito, asteriscos ou listas.\n"
)
IMAGE_RULES = (
    "- Não substitua avaliação médica nem laudo radiológico.\n"
    "- Use linguagem adequada para profissionais da saúde.\n"
    "- Seja objetivo.\n"
    "- A recomendação deve ser compatível com o nível de risco.\n"
    "- A observação deve deixar claro que o resultado é apoio à decisão clínica, "
    "baseado apenas na análise automática da imagem.\n"
    "- Não use markdown, negrito, asteriscos ou listas.\n"
)
TABULAR_FINDING = "Doença detectada pelo modelo"
IMAGE_FINDING = "Achado suspeito detectado pelo modelo"
SKIPPED_ROW_NOTICE = (
    "Interpretação por LLM não gerada para este registro para evitar excesso de chamadas."
)
SKIPPED_IMAGE_NOTICE = (
    "Interpretação por LLM não gerada para esta imagem para evitar excesso de chamadas."
)
SKIPPED_PREFIX = "Interpretação por LLM não gerada"
FALLBACK_TAIL = "Nao foi possivel gerar a interpretacao pela LLM neste momento. Detalhes tecnicos: "
FALLBACK_MARKER = "nao foi possivel gerar a interpretacao pela llm"
FALLBACK_ENDING = "o pela llm"
MANUAL_MEAN = ("Nota media geral da avaliacao qualitativa: ", " de 5.")
MANUAL_EXTREMES = ("Melhor criterio qualitativo: '", "' (", "); pior criterio: '", "' (", ").")
MANUAL_MISSING = (
    "Avaliacao qualitativa manual ainda nao preenchida - preencha a secao 6 para completar a conclusao com as notas do time."
)
RETRY_MARKERS = ["429", "quota", "resource_exhausted", "rate limit", "too many requests"]
SECTION_STEMS = {
    "tem_secao_resumo": "resumo",
    "tem_secao_risco": "risco",
    "tem_secao_justificativa": "justificativa",
    "tem_secao_recomendacao": "recomenda",
    "tem_secao_observacao": "observa",
}
DISCLAIMER_CORE = "não substitui"
DISCLAIMER_WHO = ["médic", "profissional"]
BANNED_PHRASES = [
    "o paciente possui",
    "o paciente tem",
    "diagnostico confirmado",
    "confirmadamente",
    "com certeza possui",
    "certamente possui",
    "sem duvida possui",
]
MIN_CHARS, MAX_CHARS = 200, 2500
CRITERIA = ["clareza", "coerencia", "seguranca_clinica", "utilidade_clinica", "padronizacao"]
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucn"

# --- document patterns (fixed values) ----------------------------------------------------
IMAGE_TAG = r'<img\s+src="([^"]+)"\s*(?:alt="[^"]*")?\s*/?>'
HEADER_PATTERNS = [
    r"\\pagestyle\{[^}]*\}",
    r"\\fancyhf\{[^}]*\}",
    r"\\lhead\{[^}]*\}",
    r"\\chead\{[^}]*\}",
    r"\\rhead\{[^}]*\}",
    r"\\lfoot\{[^}]*\}",
    r"\\cfoot\{[^}]*\}",
    r"\\rfoot\{[^}]*\}",
    r"\\fancyhead\[[^\]]*\]\{[^}]*\}",
    r"\\fancyfoot\[[^\]]*\]\{[^}]*\}",
    r"\\markboth\{[^}]*\}\{[^}]*\}",
    r"\\markright\{[^}]*\}",
]
BLOCK_PATTERNS = [
    r"(?s)\\usepackage\{fancyhdr\}.*?\\makeatother\n",
    r"(?s)\\fancypagestyle\{.*?\}\{.*?\}\n",
]
TITLE_PATTERNS = [
    r"\\thispagestyle\{[^}]*\}",
    r"(?s)\\title\{.*?\}\s*",
    r"(?s)\\author\{.*?\}\s*",
    r"(?s)\\date\{.*?\}\s*",
    r"\\maketitle\b",
]
BASELINE_MARK = "Baseline RandomForest"
METRIC_MARKS = ["Accuracy", "Recall", "Specificity", "F1"]
SCORE_MARKS = ["exp1=", "exp2=", "exp3="]
