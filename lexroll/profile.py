"""Rule sets that steer the operators, with one default profile.

Nothing in the operators depends on a language or a body of law: each takes one of
these objects.  The default profile fits Russian-language regulations of public bodies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Every pattern is matched with these Java flags: Unicode case folding and classes, and
# "." / "$" that know "\n" as the only line end.
REGEX_FLAGS = "(?iuUd)"

# ---------------------------------------------------------------------------------------
# Fixed values.  Results depend on these word lists, patterns and names being exactly so.
# ---------------------------------------------------------------------------------------

ANCHOR = r"\bположение\s+о\b"
CONFIRM = r"\bглава\s*1\b"
HEADER = r"^\s*(?:\d+\.?\s*)?функции(?:\s+(?:комитета|департамента))?\s*:?\s*$"
TERMINATOR = r"^\s*(?:глава|раздел)\b"
LOOKAHEAD = 12
CONTEXT_PARAGRAPHS = 150

CONTROL_CHARACTERS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
REMOVALS = (
    r"\s*сноска\s*\..*",
    r"\s*примечание\s*ИЗПИ!.*",
    r"\s*\(?вводится в действие.*?(\(|$)",
    r"\(порядок введения в действие см\. п\. \d+\)",
    r"\s*искл[ю]?че?н[оа]?.*",
    r"\s*действовал[аи]? до \d{2}\.\d{2}\.\d{4}.*",
    r";\s*от\s+\d{2}\.\d{2}\.\d{4}.*",
    r"\s*см\. п\. \d+",
)
LIST_MARKER = r"^\s*\d+(?:[-.][\w]+)*\)\s*"

LEVELS = {
    "министерство": "1",
    "агентство": "1.1",
    "комитет": "2.1",
    "департамент": "2.2",
    "управление": "2.3",
    "служба": "2.4",
    "центр": "3.1",
    "институт": "3.2",
}
PARENT_KEYWORDS = ("Министерства", "Агентства", "Комитета", "Департамента", "Управления")
STOP_WORDS = (
    "и", "по", "о", "в", "на", "об", "с", "при", "для", "над", "под", "из", "во", "со",
    "республика", "республики", "казахстан", "казахстана", "государственного", "учреждения",
)
ROOT_NAME = "Республика Казахстан"
NAME_ENDINGS = (("а", ""), ("я", "е"))

TYPE_LABELS = ("Стратегические", "Регулятивные", "Реализационные", "Контрольные", "Общие")
UNDEFINED_LABEL = "НЕОПРЕДЕЛЕНО"
ERROR_LABEL = "ОШИБКА"
CATCH_ALL_LABEL = "Общие"
TAXONOMY_WORDS = ("Сфера: ", ". Описание: ", ". Деятельность: ")
NODE_WORDS = ("Название сферы: ", "\nОписание: ", "\nВиды деятельности: ")
NODE_LIST_WORDS = ("\n\nСПИСОК ДОСТУПНЫХ СФЕР:\n---\n", "\n---\n", "\n---")
PAIR_WORDS = ("FUNCTION ", "ID: ", "Executor: ", "Type: ", "Sphere: ", "Text: ", "N/A")
PAIR_CLOSING = "Analyze if these functions represent a REAL collision or FALSE alarm."
HINT_WORDS = (
    "\n\nSIMILARITY ANALYSIS: Based on semantic proximity to verified examples, the most likely types are: ",
    ". Please consider this information when making your verdict.",
)
NO_MATCH = "NO_MATCH"
CODELESS = ("", "nan", "None", "NO_MATCH", "ОШИБКА", "ERROR")

NO_COLLISION = "NO_COLLISION"
GROUP_PREFIX = "COLLISION_"

LEVEL_TAGS = {
    "1": "#Центральные_аппараты",
    "2": "#Комитеты_и_департаменты",
    "3": "#Управления",
    "4": "#Руководители_ЦА",
    "5": "#Директоры",
    "6": "#Руководители_отделов",
    "7": "#Главные_специалисты",
    "8": "#Специалисты",
}

PAIR_THRESHOLD = 0.50
BOILERPLATE_THRESHOLD = 0.75
HINTS = 3
TOP_NODES = 10
EMBED_BATCH = 64
ATTEMPTS = 3
BACKOFF_SECONDS = 2.0

# Titles of the functions-of-government code list: divisions "dd" and groups "dd.d".
CODE_TITLES = {
    "01": "ГОСУДАРСТВЕННЫЕ СЛУЖБЫ ОБЩЕГО НАЗНАЧЕНИЯ",
    "01.1": "ИСПОЛНИТЕЛЬНЫЕ И ЗАКОНОДАТЕЛЬНЫЕ ОРГАНЫ, БЮДЖЕТНО-ФИНАНСОВЫЕ ВОПРОСЫ, МЕЖДУНАРОДНЫЕ ОТНОШЕНИЯ",
    "01.2": "ИНОСТРАННАЯ ЭКОНОМИЧЕСКАЯ ПОМОЩЬ",
    "01.3": "ОБЩИЕ СЛУЖБЫ",
    "01.4": "ФУНДАМЕНТАЛЬНЫЕ ИССЛЕДОВАНИЯ",
    "01.5": "НИОКР, СВЯЗАННЫЕ С ГОСУДАРСТВЕННЫМИ СЛУЖБАМИ ОБЩЕГО НАЗНАЧЕНИЯ",
    "01.6": "ГОСУДАРСТВЕННЫЕ СЛУЖБЫ ОБЩЕГО НАЗНАЧЕНИЯ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "01.7": "ОПЕРАЦИИ, СВЯЗАННЫЕ С ГОСУДАРСТВЕННЫМ ДОЛГОМ",
    "01.8": "ТРАНСФЕРТЫ ОБЩЕГО ХАРАКТЕРА МЕЖДУ ОРГАНАМИ ГОСУДАРСТВЕННОГО УПРАВЛЕНИЯ РАЗЛИЧНОГО УРОВНЯ",
    "02": "ОБОРОНА",
    "02.1": "ВООРУЖЕННЫЕ СИЛЫ",
    "02.2": "ГРАЖДАНСКАЯ ОБОРОНА",
    "02.3": "ИНОСТРАННАЯ ВОЕННАЯ ПОМОЩЬ",
    "02.4": "НИОКР В ОБЛАСТИ ОБОРОНЫ",
    "02.5": "ВОПРОСЫ ОБОРОНЫ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "03": "ОБЩЕСТВЕННЫЙ ПОРЯДОК И БЕЗОПАСНОСТЬ",
    "03.1": "ПОЛИЦЕЙСКИЕ СЛУЖБЫ",
    "03.2": "ПОЖАРНАЯ ОХРАНА",
    "03.3": "СУДЫ",
    "03.4": "ТЮРЬМЫ",
    "03.5": "НИОКР, СВЯЗАННЫЕ С ВОПРОСАМИ ОБЩЕСТВЕННОГО ПОРЯДКА И БЕЗОПАСНОСТИ",
    "03.6": "ВОПРОСЫ ОБЩЕСТВЕННОГО ПОРЯДКА И БЕЗОПАСНОСТИ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "04": "ЭКОНОМИЧЕСКИЕ ВОПРОСЫ",
    "04.1": "ОБЩИЕ ЭКОНОМИЧЕСКИЕ И КОММЕРЧЕСКИЕ ВОПРОСЫ И ВОПРОСЫ, ОТНОСЯЩИЕСЯ К РАБОЧЕЙ СИЛЕ",
    "04.2": "СЕЛЬСКОЕ ХОЗЯЙСТВО, ЛЕСНОЕ ХОЗЯЙСТВО, РЫБОЛОВСТВО И ОХОТА",
    "04.3": "ТОПЛИВО И ЭНЕРГЕТИКА",
    "04.4": "ГОРНОДОБЫВАЮЩАЯ ПРОМЫШЛЕННОСТЬ, ОБРАБАТЫВАЮЩАЯ ПРОМЫШЛЕННОСТЬ И СТРОИТЕЛЬСТВО",
    "04.5": "ТРАНСПОРТ",
    "04.6": "СВЯЗЬ",
    "04.7": "ПРОЧИЕ ОТРАСЛИ",
    "04.8": "НИОКР, СВЯЗАННЫЕ С ЭКОНОМИЧЕСКИМИ ВОПРОСАМИ",
    "04.9": "ЭКОНОМИЧЕСКИЕ ВОПРОСЫ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "05": "ОХРАНА ОКРУЖАЮЩЕЙ СРЕДЫ",
    "05.1": "СБОР И УДАЛЕНИЕ ОТХОДОВ",
    "05.2": "УДАЛЕНИЕ И ОЧИСТКА СТОЧНЫХ ВОД",
    "05.3": "БОРЬБА С ЗАГРЯЗНЕНИЕМ ОКРУЖАЮЩЕЙ СРЕДЫ",
    "05.4": "ЗАЩИТА БИОРАЗНООБРАЗИЯ И ОХРАНА ЛАНДШАФТА",
    "05.5": "НИОКР В ОБЛАСТИ ОХРАНЫ ОКРУЖАЮЩЕЙ СРЕДЫ",
    "05.6": "ВОПРОСЫ ОХРАНЫ ОКРУЖАЮЩЕЙ СРЕДЫ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "06": "ЖИЛИЩНЫЕ И КОММУНАЛЬНЫЕ УСЛУГИ",
    "06.1": "ЖИЛИЩНОЕ СТРОИТЕЛЬСТВО",
    "06.2": "КОММУНАЛЬНОЕ РАЗВИТИЕ",
    "06.3": "ВОДОСНАБЖЕНИЕ",
    "06.4": "ОСВЕЩЕНИЕ УЛИЦ",
    "06.5": "НИОКР В ОБЛАСТИ ЖИЛИЩНОГО И КОММУНАЛЬНОГО ХОЗЯЙСТВА",
    "06.6": "ЖИЛИЩНЫЕ И КОММУНАЛЬНЫЕ УСЛУГИ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "07": "ЗДРАВООХРАНЕНИЕ",
    "07.1": "МЕДИЦИНСКАЯ ПРОДУКЦИЯ, ОБОРУДОВАНИЕ И ИЗДЕЛИЯ, ИСПОЛЬЗУЕМЫЕ В МЕДИЦИНЕ",
    "07.2": "АМБУЛАТОРНЫЕ УСЛУГИ",
    "07.3": "УСЛУГИ БОЛЬНИЦ",
    "07.4": "УСЛУГИ В ОБЛАСТИ ЗДРАВООХРАНЕНИЯ",
    "07.5": "НИОКР В ОБЛАСТИ ЗДРАВООХРАНЕНИЯ",
    "07.6": "ВОПРОСЫ ЗДРАВООХРАНЕНИЯ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "08": "ОТДЫХ, КУЛЬТУРА И РЕЛИГИЯ",
    "08.1": "УСЛУГИ В ОБЛАСТИ ОРГАНИЗАЦИИ ОТДЫХА И ЗАНЯТИЙ СПОРТОМ",
    "08.2": "УСЛУГИ В ОБЛАСТИ КУЛЬТУРЫ",
    "08.3": "УСЛУГИ В ОБЛАСТИ РАДИО- И ТЕЛЕВЕЩАНИЯ И ИЗДАТЕЛЬСКОГО ДЕЛА",
    "08.4": "РЕЛИГИОЗНЫЕ И ДРУГИЕ ОБЩЕСТВЕННЫЕ УСЛУГИ",
    "08.5": "НИОКР В ОБЛАСТИ ОТДЫХА, КУЛЬТУРЫ И РЕЛИГИИ",
    "08.6": "ВОПРОСЫ ОТДЫХА, КУЛЬТУРЫ И РЕЛИГИИ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "09": "ОБРАЗОВАНИЕ",
    "09.1": "ДОШКОЛЬНОЕ И НАЧАЛЬНОЕ ОБРАЗОВАНИЕ",
    "09.2": "СРЕДНЕЕ ОБРАЗОВАНИЕ",
    "09.3": "ПРОДОЛЖЕННОЕ СРЕДНЕЕ ОБРАЗОВАНИЕ",
    "09.4": "ВЫСШЕЕ ОБРАЗОВАНИЕ",
    "09.5": "ОБРАЗОВАНИЕ, НЕ ПОДРАЗДЕЛЕННОЕ ПО СТУПЕНЯМ",
    "09.6": "ВСПОМОГАТЕЛЬНЫЕ УСЛУГИ В СИСТЕМЕ ОБРАЗОВАНИЯ",
    "09.7": "НИОКР В ОБЛАСТИ ОБРАЗОВАНИЯ",
    "09.8": "ВОПРОСЫ ОБРАЗОВАНИЯ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "10": "СОЦИАЛЬНАЯ ЗАЩИТА",
    "10.1": "ЗАБОЛЕВАНИЯ И НЕТРУДОСПОСОБНОСТЬ",
    "10.2": "СТАРОСТЬ",
    "10.3": "ИЖДИВЕНЦЫ, ОСТАВШИЕСЯ БЕЗ КОРМИЛЬЦА",
    "10.4": "СЕМЬЯ И ДЕТИ",
    "10.5": "БЕЗРАБОТИЦА",
    "10.6": "ЖИЛЬЕ",
    "10.7": "ВОПРОСЫ СОЦИАЛЬНОЙ НЕУСТРОЕННОСТИ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
    "10.8": "НИОКР В ОБЛАСТИ СОЦИАЛЬНОЙ ЗАЩИТЫ",
    "10.9": "ВОПРОСЫ СОЦИАЛЬНОЙ ЗАЩИТЫ, НЕ ОТНЕСЕННЫЕ К ДРУГИМ КАТЕГОРИЯМ",
}

# ---------------------------------------------------------------------------------------
# Rule objects
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SectionRules:
    """How ordered paragraphs fall into sections and items."""

    anchor: str = ANCHOR
    confirm: str = CONFIRM
    header: str = HEADER
    terminator: str = TERMINATOR
    lookahead: int = LOOKAHEAD
    context: int = CONTEXT_PARAGRAPHS
    flags: str = REGEX_FLAGS


@dataclass(frozen=True)
class CleanRules:
    """How one item text is cleaned: ordered removals, then one leading list marker."""

    control: str = CONTROL_CHARACTERS
    removals: tuple[str, ...] = REMOVALS
    marker: str = LIST_MARKER
    flags: str = REGEX_FLAGS


@dataclass(frozen=True)
class NameRules:
    """How names of bodies are split, abbreviated and given a level."""

    parent_keywords: tuple[str, ...] = PARENT_KEYWORDS
    endings: tuple[tuple[str, str], ...] = NAME_ENDINGS
    stop_words: tuple[str, ...] = STOP_WORDS
    levels: dict[str, str] = field(default_factory=lambda: dict(LEVELS))
    root: str = ROOT_NAME
    word: str = r"[A-Za-zА-Яа-яЁё]+"
    blank_abbreviation: str = "GO"


@dataclass(frozen=True)
class LabelRules:
    """The closed label set and the marks used for undecided and failed rows."""

    labels: tuple[str, ...] = TYPE_LABELS
    undefined: str = UNDEFINED_LABEL
    error: str = ERROR_LABEL
    no_match: str = NO_MATCH
    codeless: tuple[str, ...] = CODELESS


@dataclass(frozen=True)
class ReportRules:
    """Words of the report pages."""

    # Fixed values, as those at the head of this file.
    level_title: str = "# Функции уровня "
    contents: str = "## Содержание"
    functions: str = "### Функции"
    type_word: str = "Тип: "
    sphere_word: str = "Сфера (ур. 2): "
    collision_word: str = "Коллизия: "
    group_title: str = "# Группа коллизий: "
    group_items: str = "## Функции в группе"
    executor_word: str = "**Исполнитель:** "
    verdict_word: str = "**Вердикт:** "
    no_text: str = "Текст функции отсутствует"
    portrait_title: str = "# Портрет исполнителя: "
    statistics: str = "## Общая статистика"
    total_word: str = "**Общее количество функций:** "
    collisions_word: str = "**Функций с коллизиями:** "
    types_title: str = "### Распределение по типам функций"
    types_head: tuple[str, str] = ("| Тип | Количество | Доля |", "|-----|------------|------|")
    spheres_title: str = "### Распределение по сферам"
    spheres_head: tuple[str, str] = ("| Сфера | Количество | Доля |", "|-------|------------|------|")
    list_title: str = "## Список функций"
    details_word: str = "**Детали:** "
    bullet: str = "⚙️"
    tags: dict[str, str] = field(default_factory=lambda: dict(LEVEL_TAGS))
    tag_fallback: str = "#Уровень_"
