"""Ordered word lists. Order is part of the meaning, as substitutions run one after the other."""

from __future__ import annotations

# The values below are fixed by the documents' conventions and stand in their natural order.

#: Terms annotated in source documents.
PRESERVE_TERMS = (
    ("问天", "WenTian"),
    ("联想问天", "Lenovo WenTian"),
    ("天擎", "ThinkSystem"),
    ("至强", "Xeon"),
    ("英特尔", "Intel"),
    ("处理器", "Processor"),
    ("内存", "Memory"),
    ("存储", "Storage"),
    ("网卡", "Network Adapter"),
    ("电源", "Power Supply"),
    ("服务器", "Server"),
    ("机架", "Rack"),
    ("刀片", "Blade"),
    ("交换机", "Switch"),
)

#: Terms put in before any dictionary.
TECHNICAL_TERMS = (
    ("问天", "WenTian"),
    ("联想问天", "Lenovo WenTian"),
    ("天擎", "ThinkSystem"),
    ("AnyBay", "AnyBay"),
    ("至强", "Xeon"),
    ("可扩展处理器", "Scalable Processors"),
    ("英特尔", "Intel"),
    ("处理器", "Processor"),
    ("内核", "Core"),
    ("线程", "Thread"),
    ("睿频", "Turbo Boost"),
    ("内存", "Memory"),
    ("存储", "Storage"),
    ("硬盘", "Drive"),
    ("固态硬盘", "SSD"),
    ("机械硬盘", "HDD"),
    ("热插拔", "Hot-swap"),
    ("冗余", "Redundancy"),
    ("背板", "Backplane"),
    ("托架", "Tray"),
    ("以太网", "Ethernet"),
    ("光纤", "Fiber"),
    ("带宽", "Bandwidth"),
    ("延迟", "Latency"),
    ("网卡", "Network Adapter"),
    ("英寸", "inch"),
    ("机架", "Rack"),
    ("插槽", "Slot"),
    ("转接卡", "Riser Card"),
    ("电源", "Power Supply"),
    ("铂金", "Platinum"),
    ("钛金", "Titanium"),
    ("CRPS", "CRPS"),
)

#: Dictionaries by target language; an empty target leaves the word.
TO_RUSSIAN = (
    ("文档", "документ"),
    ("技术", "технический"),
    ("规格", "спецификация"),
    ("说明", "описание"),
    ("安装", "установка"),
    ("配置", "конфигурация"),
    ("管理", "управление"),
    ("监控", "мониторинг"),
    ("维护", "обслуживание"),
    ("故障", "неисправность"),
    ("排除", "устранение"),
    ("性能", "производительность"),
    ("优化", "оптимизация"),
    ("升级", "обновление"),
    ("兼容", "совместимость"),
    ("支持", "поддержка"),
    ("推荐", "рекомендуется"),
    ("要求", "требования"),
    ("注意", "внимание"),
    ("警告", "предупреждение"),
    ("重要", "важно"),
    ("个", ""),
    ("台", "шт."),
    ("套", "комплект"),
    ("只", "шт."),
    ("条", "шт."),
    ("根", "шт."),
    ("表", "таблица"),
    ("列表", "список"),
    ("项目", "элемент"),
    ("选项", "опция"),
    ("参数", "параметр"),
    ("值", "значение"),
    ("默认", "по умолчанию"),
    ("可选", "опционально"),
    ("必须", "обязательно"),
    ("点击", "нажмите"),
    ("选择", "выберите"),
    ("输入", "введите"),
    ("确认", "подтвердите"),
    ("取消", "отмените"),
    ("保存", "сохраните"),
    ("删除", "удалите"),
    ("修改", "измените"),
    ("添加", "добавьте"),
    ("移除", "удалите"),
)

TO_ENGLISH = (
    ("文档", "document"),
    ("技术", "technical"),
    ("规格", "specification"),
    ("说明", "description"),
    ("安装", "installation"),
    ("配置", "configuration"),
    ("管理", "management"),
    ("监控", "monitoring"),
    ("维护", "maintenance"),
    ("故障", "fault"),
    ("排除", "troubleshooting"),
    ("性能", "performance"),
    ("优化", "optimization"),
    ("升级", "upgrade"),
    ("兼容", "compatibility"),
    ("支持", "support"),
    ("推荐", "recommended"),
    ("要求", "requirements"),
    ("注意", "note"),
    ("警告", "warning"),
    ("重要", "important"),
    ("个", ""),
    ("台", "units"),
    ("套", "set"),
    ("只", "piece"),
    ("条", "item"),
    ("根", "piece"),
    ("表", "table"),
    ("列表", "list"),
    ("项目", "item"),
    ("选项", "option"),
    ("参数", "parameter"),
    ("值", "value"),
    ("默认", "default"),
    ("可选", "optional"),
    ("必须", "required"),
    ("点击", "click"),
    ("选择", "select"),
    ("输入", "enter"),
    ("确认", "confirm"),
    ("取消", "cancel"),
    ("保存", "save"),
    ("删除", "delete"),
    ("修改", "modify"),
    ("添加", "add"),
    ("移除", "remove"),
)

#: Terminology of the line translator.
TERMINOLOGY = (
    ("问天", "WenTian"),
    ("联想问天", "Lenovo WenTian"),
    ("天擎", "ThinkSystem"),
    ("AnyBay", "AnyBay"),
    ("至强", "Xeon"),
    ("可扩展处理器", "Scalable Processors"),
    ("英特尔", "Intel"),
    ("处理器", "Processor"),
    ("内核", "Core"),
    ("线程", "Thread"),
    ("睿频", "Turbo Boost"),
    ("内存", "Memory"),
    ("存储", "Storage"),
    ("硬盘", "Drive"),
    ("固态硬盘", "SSD"),
    ("机械硬盘", "HDD"),
    ("热插拔", "Hot-swap"),
    ("冗余", "Redundancy"),
    ("背板", "Backplane"),
    ("托架", "Tray"),
    ("以太网", "Ethernet"),
    ("光纤", "Fiber"),
    ("带宽", "Bandwidth"),
    ("延迟", "Latency"),
    ("网卡", "Network Adapter"),
    ("风冷", "Air cooling"),
    ("液冷", "Liquid cooling"),
    ("散热", "Cooling"),
    ("风扇", "Fan"),
    ("散热器", "Heatsink"),
    ("英寸", "inch"),
    ("机架", "Rack"),
    ("插槽", "Slot"),
    ("转接卡", "Riser Card"),
    ("电源", "Power Supply"),
    ("铂金", "Platinum"),
    ("钛金", "Titanium"),
    ("CRPS", "CRPS"),
    ("芯片组", "Chipset"),
    ("控制器", "Controller"),
    ("适配器", "Adapter"),
    ("光驱", "Optical Drive"),
)

TERMINOLOGY_RU = (
    ("问天", "WenTian"),
    ("联想问天", "Lenovo WenTian"),
    ("至强", "Xeon"),
    ("可扩展处理器", "Scalable процессоры"),
    ("英特尔", "Intel"),
    ("处理器", "процессор"),
    ("内核", "ядро"),
    ("线程", "поток"),
    ("内存", "память"),
    ("存储", "хранилище"),
    ("硬盘", "диск"),
    ("固态硬盘", "SSD"),
    ("机械硬盘", "HDD"),
    ("热插拔", "горячая замена"),
    ("冗余", "резервирование"),
    ("托架", "лоток"),
    ("以太网", "Ethernet"),
    ("带宽", "пропускная способность"),
    ("延迟", "задержка"),
    ("风冷", "воздушное охлаждение"),
    ("液冷", "жидкостное охлаждение"),
    ("散热器", "радиатор"),
    ("机架", "стойка"),
    ("插槽", "слот"),
    ("电源", "блок питания"),
    ("铂金", "платиновый"),
    ("钛金", "титановый"),
)

#: Words of headings by target language.
HEADING_WORDS = {
    "ru": (("第", "Глава"), ("章", ""), ("节", "Раздел"), ("部分", "Часть"), ("概述", "Обзор"), ("介绍", "Введение"), ("总结", "Заключение"), ("附录", "Приложение")),
    "en": (("第", "Chapter"), ("章", ""), ("节", "Section"), ("部分", "Part"), ("概述", "Overview"), ("介绍", "Introduction"), ("总结", "Summary"), ("附录", "Appendix")),
}

#: Terms that quality checks look for, whatever their case.
QA_TERMS = (
    "WenTian", "Lenovo WenTian", "ThinkSystem", "AnyBay", "问天", "联想问天", "天擎",
    "Xeon", "Intel", "Scalable Processors", "至强", "可扩展处理器", "英特尔",
    "IPMI", "BMC", "Redfish", "ipmitool", "chassis", "power", "sensor", "sel", "fru", "user", "sol",
    "Power Supply", "Ethernet", "Storage", "Memory", "Processor", "Network", "Rack", "Server",
    "Hot-swap", "Redundancy", "Backplane", "Tray", "Fiber", "Bandwidth", "Latency",
    "Network Adapter", "Slot", "Riser Card", "Platinum", "Titanium", "CRPS",
)
REQUIRED_TERMS = (
    "IPMI", "BMC", "Redfish", "ipmitool", "API", "HTTP", "REST", "JSON", "XML", "SNMP", "SSH", "Telnet", "CLI", "GUI",
    "firmware", "BIOS", "UEFI", "sensor", "temperature", "voltage", "power", "fan", "CPU", "memory", "storage",
)
REQUIRED_SECTIONS = ("введение", "обзор", "конфигурация", "заключение")
CONSISTENT_PAIRS = (("问天", "WenTian"), ("联想", "Lenovo"))

CONTENT_KEYWORDS = ("преобразуй", "markdown", "структура", "таблица", "pdf", "документ", "извлечение", "форматирование")
TRANSLATION_KEYWORDS = ("переведи", "translate", "перевод", "translation", "русский", "english", "中文", "язык", "language")
LANGUAGE_NAMES = (("zh-CN", "китайский"), ("zh", "китайский"), ("ru", "русский"), ("en", "английский"))

#: Patterns of headings in source documents, in the order they are tried.
HEADING_PATTERNS = (
    r"^[第章节]\s*[一二三四五六七八九十\d]+\s*[章节]",
    r"^[一二三四五六七八九十]+[、．]",
    r"^\d+[、．]\s*[\x{4e00}-\x{9fff}]",
    r"^[\x{4e00}-\x{9fff}]+[:：]",
)
#: Patterns of headings in extracted text, whatever their case.
TEXT_HEADING_PATTERNS = (
    r"^[IVX]{1,4}\.?\s+", r"^\d+\.?\s+", r"^\d+\.\d+\.?\s+", r"^\d+\.\d+\.\d+\.?\s+",
    r"^[A-Za-zА-Яа-я]+\.?\s+", r"^Глава\s+\d+", r"^Раздел\s+\d+", r"^Часть\s+\d+",
)
#: What language models leave behind; the first list removes, the second counts.
SCRUB_PATTERNS = (
    r"<думаю>.*?</думаю>", r"<thinking>.*?</thinking>", r"[Хх]орошо[,\s]*мне нужно[^.]*?\.", r"[Сс]начала посмотр[^.]*?\.",
    r"Let me[^.]*?\.", r"First[,\s]*I[^.]*?\.", r"[Вв]от перевод[^:]*:?\s*", r"Here is[^:]*:?\s*", r"[Нн]иже представлен[^:]*:?\s*",
)
THINKING_PATTERNS = (
    r"[Хх]орошо[,\s]*мне", r"[Сс]начала посмотр", r"Let me", r"First I", r"[Вв]от перевод", r"Here is", r"[Нн]иже представлен",
    r"<думаю>", r"</думаю>", r"<thinking>", r"</thinking>",
)
BRAND_FIXES = (r"\b[Qq]itian\b", r"\bSkyland\b", r"\bSkyStorage\b")
BATCH_SIZES = (("empty", 20), ("header", 4), ("table", 3), ("complex_table", 1), ("technical_specs", 3), ("commands", 2), ("mixed", 4), ("text", 6))
#: Words of errors in the order they are tried: pattern, category, action.
ERROR_RULES = (
    ("TableData is not JSON serializable", "serialization_error", "disable_table_extraction"),
    ("Permission denied", "permission_error", "check_file_permissions"),
    ("No such file or directory", "file_not_found", "verify_file_path"),
)
SEVERITY_PENALTY = (("low", 0.01), ("medium", 0.05), ("high", 0.1), ("critical", 0.2))
