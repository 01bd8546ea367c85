"""Configuration values of the academic domain.

FIXED VALUES — these must equal the studied system's values for the outputs
to agree; they are stated here plainly, in their natural order, in one place.
"""

from __future__ import annotations

# --- fixed values: course-code unification (code -> (unified code, unified name)) ---
COURSE_CODE_MAP: list[tuple[str, str, str]] = [
    ("034", "034", "ADMINISTRAÇÃO"),
    ("064", "064", "CIÊNCIAS BIOLÓGICAS"),
    ("062", "064", "CIÊNCIAS BIOLÓGICAS"),
    ("057", "064", "CIÊNCIAS BIOLÓGICAS"),
    ("009", "009", "CIÊNCIAS CONTÁBEIS"),
    ("023", "009", "CIÊNCIAS CONTÁBEIS"),
    ("055", "055", "CURSO SUPERIOR DE TECNOLOGIA EM GESTÃO DE RECURSOS HUMANOS"),
    ("056", "056", "DESIGN"),
    ("141", "056", "DESIGN"),
    ("031", "031", "DIREITO"),
    ("065", "065", "EDUCAÇÃO FÍSICA"),
    ("036", "065", "EDUCAÇÃO FÍSICA"),
    ("037", "065", "EDUCAÇÃO FÍSICA"),
    ("013", "013", "ENFERMAGEM"),
    ("079", "079", "ENGENHARIA"),
    ("006", "006", "ENGENHARIA CIVIL"),
    ("020", "006", "ENGENHARIA CIVIL"),
    ("097", "097", "ENGENHARIA DA COMPUTAÇÃO"),
    ("059", "059", "ENGENHARIA DE PRODUÇÃO"),
    ("142", "059", "ENGENHARIA DE PRODUÇÃO"),
    ("044", "044", "ENGENHARIA ELÉTRICA"),
    ("139", "044", "ENGENHARIA ELÉTRICA"),
    ("017", "017", "ENGENHARIA MECÂNICA"),
    ("132", "017", "ENGENHARIA MECÂNICA"),
    ("126", "126", "FARMÁCIA"),
    ("060", "060", "JORNALISMO"),
    ("014", "014", "MEDICINA"),
    ("024", "024", "NUTRIÇÃO"),
    ("007", "007", "ODONTOLOGIA"),
    ("130", "007", "ODONTOLOGIA"),
    ("128", "128", "PEDAGOGIA"),
    ("145", "145", "PSICOLOGIA"),
    ("061", "061", "PUBLICIDADE E PROPAGANDA"),
    ("025", "025", "SERVIÇO SOCIAL"),
    ("019", "019", "SISTEMAS DE INFORMAÇÃO"),
    ("999", "999", "COMPARTILHADA"),
]
SHARED_COURSE = "999"
SHARED_COURSE_NAME = "COMPARTILHADA"
# courses whose subject codes keep the bare subject code (no initials suffix)
BARE_SUBJECT_CODE_COURSES = ["005", "014"]

# --- fixed values: exam code -> display name (identity fallback) ---
EXAM_LABELS: list[tuple[str, str]] = [
    ("AVF", "Avaliação Formativa"),
    ("AVS", "Avaliação Somativa"),
    ("AVSB", "Avaliação Substitutiva"),
    ("AVD1", "Avaliação 1"),
    ("AVD2", "Avaliação 2"),
    ("SUBST", "Avaliação Substitutiva"),
    ("AV", "Avaliação"),
]

# --- fixed values: shift synonyms (upper-cased, stripped) ---
SHIFT_SYNONYMS: list[tuple[str, list[str]]] = [
    ("M", ["M", "MANHÃ", "MANHA", "MANH"]),
    ("T", ["T", "TARDE", "TARD"]),
    ("N", ["N", "NOITE", "NOIT"]),
    ("I", ["I", "INTEGRAL", "INT"]),
]
VALID_SHIFTS = ["M", "T", "N", "I"]
DEFAULT_OFFERING_SHIFT = "M"

# --- fixed values: mailbox domains ---
STUDENT_DOMAIN_TECH = "@etecfoa.com.br"   # teaching unit 007
STUDENT_DOMAIN_DEFAULT = "@unifoa.edu.br"
TECH_UNIT = "007"
TEACHER_DOMAIN = "foa.org.br"
INSTITUTIONAL_DOMAINS = ["foa.org.br", "unifoa.edu.br", "etecfoa.com.br"]

# --- fixed values: accepted value sets of the validation rules ---
ACTIVE_FLAG_VALUES = ["S", "N", "A", "I", "1", "0", "TRUE", "FALSE"]
GENDER_VALUES = ["M", "F", "MASCULINO", "FEMININO", "MALE", "FEMALE"]
STUDENT_STATUS_VALUES = ["ATIVO", "INATIVO", "CURSANDO", "FORMADO", "EVADIDO", "TRANCADO", "JUBILADO", "S"]
USER_ROLE_VALUES = ["C", "P"]

# --- fixed values: load filters ---
KNOWLEDGE_AREAS = [
    "Obrigatória",
    "Optativa",
    "Disciplinas Obrigatórias",
    "Extensão Curricularizada",
    "Pesquisa Curricularizada",
]
INCLUDED_FACULTIES = ["001"]
OPEN_CLASS_STATUS = "aberta"
ACTIVE_STUDENT_STATUS = "Ativo"
ORG_UNIT_CODE = "4000000001"
NOT_INFORMED = "Não informado"

# --- fixed values: messages of the rule registry ---
MSG_REQUIRED_MISSING = "Campo obrigatório '{field}' não informado"
MSG_REQUIRED_BLANK = "Campo obrigatório '{field}' está vazio"
MSG_MAX_LENGTH = "Campo '{field}' excede o tamanho máximo de {n} caracteres"
MSG_MIN_VALUE = "Campo '{field}' deve ser maior ou igual a {v}"
MSG_MAX_VALUE = "Campo '{field}' deve ser menor ou igual a {v}"
MSG_NOT_NUMBER = "Campo '{field}' deve ser um número"
MSG_BAD_EMAIL = "Formato de email inválido"
MSG_NOT_INSTITUTIONAL = "Email não parece ser institucional"
MSG_RECORD_BAD_EMAIL = "Email inválido: {value}"
MSG_RECORD_BAD_BIRTH = "Data de nascimento inválida: {value}"

# --- fixed values: enrolment / un-enrolment feed constants ---
FEED_CLASS_SUBJECT_ID = "d575b0e5-9193-4737-bdc2-567f5bf246f7"
FEED_CURRICULUM_ID = "998202621"
FEED_PERIOD_ID = "ed45c7d0-6e6e-466b-b9d1-43fcd6cbd9d4"
FEED_ENROLMENT_STATUS_ID = "eccd4f88-229c-4458-8177-cacc85cbdbb8"
FEED_UNIT = "002"
FEED_COLUMNS = [
    "externalEnrollmentId", "externalClassSubjectId", "externalCurriculumId", "externalPeriodId",
    "startDate", "endDate", "externalEnrollmentClassSubjectStatusId", "externalEnrollmentTypeId",
    "ext.info.tags",
]
