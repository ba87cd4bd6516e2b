"""Fixed values.

These strings must equal the reference's output values and column names exactly; they are stated
here once, in natural order, and used by name everywhere else.
"""

# --- fixed values: measure-type tags -------------------------------------------------------------
PLAN = "план"
FACT = "факт"

# --- fixed values: project types ------------------------------------------------------------------
PROJECT = "проект"
SNAPSHOT_NZ = "НЗ"
SNAPSHOT_OVNZ = "ОВНЗ"

# --- fixed values: delivery mode ("Силы реализации") mapping, source value -> label ------------------
OWN_FORCES_LABEL = "Собственными силами"
SUBCONTRACT_LABEL = "Силами субподрядных организаций"
DELIVERY_MODE_MAP = {
    "Собственные силы": OWN_FORCES_LABEL,
    "Собственными силами": OWN_FORCES_LABEL,
    "Субподряд": SUBCONTRACT_LABEL,
    "Силами субподрядных организаций": SUBCONTRACT_LABEL,
}

# --- fixed values: structure ("Конструктив") labels --------------------------------------------------
EARTHWORK = "Земляное полотно"
PAVEMENT = "Дорожная одежда"
OTHER_WORKS = "Прочие работы"

# --- fixed values: resource ownership labels ---------------------------------------------------------
OWN_RESOURCE = "Собственная"
HIRED_RESOURCE = "Наемная"
HIRED_PREFIX_PATTERN = "(НТ)%"

# --- fixed values: adjusted-resource code and the planning-system resource-code pattern -----------
MAIN_WORKER_CODE = "Mont"
HIRED_RESCODE_PATTERN = "NT_%"
CODE_PREFIX_TO_STRIP = "Kzn_"

# --- fixed values: check status texts ------------------------------------------------------------------
STATUS_FACT_IN_NZ = "Фактические значения в НЗ"
STATUS_PLAN_IN_OVNZ = "Плановые значения в ОВНЗ"
STATUS_DUPLICATE = "ДУБЛИРОВАНИЕ"
STATUS_ERROR = "ОШИБКА"

# --- fixed values: mixed-period label, formatted with the two period years ---------------------------
MIXED_PERIOD_TEMPLATE = "между {first} и {second}"

# --- fixed values: Russian month names, January..December (snapshot month column) -----------------
RUS_MONTHS = ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
              "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"]

# --- fixed values: output column names -------------------------------------------------------------------
COL_WORK_NAME = "Наименование работ и затрат"
COL_CIPHER = "Шифр единичной расценки"
COL_CONTRACT_SMR = "СМР П"
COL_VOLUME = "объем"
COL_UNITS = "Единицы измерения"
COL_POSITION = "Позиция из КВ"
COL_UNIT_PRICE = "Единичная расценка"
COL_DELIVERY_MODE = "Силы реализации"
COL_STRUCTURE = "Конструктив"
COL_STRUCTURE_ELEMENT = "Конструктивный элемент"
COL_WORK_KIND = "Вид работ"
COL_ENRP_TYPE = "Тип ЕНРП"
COL_SPIDER_RESOURCE = "Ресурс Spider"
COL_RESOURCE_CODE = "Код ресурса"
COL_FACT_HOURS = "Фактическая трудоемкость"
COL_NORM_HOURS = "Нормативная трудоемкость"
COL_NORMED = "Нормируемая"
COL_RESOURCE = "Ресурс"
COL_DATE = "Дата"
COL_SHIFT = "Смена"
COL_YEAR = "Год"
COL_MONTH = "Месяц"
COL_DEVIATION = "Недопустимый % отклонения"
COL_KEY_RESOURCE = "Ключевой ресурс"

# The thirteen cost components of the planning system, in the reference's order.
COST_PARTS = ["AmLiz", "FnOpTr", "FuelMiM", "Materl", "OplGpd", "OpSbRb", "PrMatl",
              "ProZtr", "St_Mex", "StrVzn", "UslStH", "RepMiM", "NkRuch"]

#: Hours are exact numbers of four decimals from the source tables to the marts.
HOURS_TYPE = "decimal(18,4)"
