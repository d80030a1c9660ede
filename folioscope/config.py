"""Parameters of the page operators. All are values of one frozen object that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass, field

# The role catalogue. "merged" is the entry that two roles share in the strict catalogue.
_ROLES = [
    "Gerente de Contrato",
    "Jefe de Supervisión",
    "Supervisor de Obra",
    "Especialista en Arquitectura",
    "Especialista en Estructuras",
    "Especialista en Instalaciones Eléctricas",
    "Especialista en Instalaciones Sanitarias",
    "Especialista en Instalaciones Mecánicas",
    "Especialista en Seguridad y Salud",
    "Especialista en Seguridad Salud y Medio Ambiente",
    "Especialista en Metrados y Costos",
    "Especialista en Metrados Costos y Valorizaciones",
    "Especialista en Calidad",
    "Especialista en Control y Aseguramiento de Calidad",
    "Especialista BIM",
    "Especialista en Equipamiento",
    "Especialista en Equipamiento Hospitalario",
    "Especialista en Implementacion de Soluciones de Tecnologia de la Informacion",
    "Especialista en Configuraciones Tecnologicas de la Informacion y Comunicaciones",
    "Especialista en Instalaciones de Comunicaciones",
    "Especialista TIC",
    "Especialista de Pre Instalación de Equipamiento HospitalarioEspecialista en Supervisión de Estructuras",
    "Especialista en Supervisión de Arquitectura",
    "Especialista en Supervisión del Medio Ambiente",
    "Especialista en Supervisión de Control de Calidad",
    "Supervisión de Coordinador BIM",
    "Especialista en Supervisión de Instalaciones Sanitarias",
    "Especialista en Supervisión de Instalaciones Mecánicas",
    "Especialista en Supervisión de Instalaciones Eléctricas",
    "Especialista en Supervisión de Instalaciones Comunicaciones",
    "Especialista en Supervisión de Geotecnia",
    "Especialista en Supervisión de Equipamiento Hospitalario",
    "Especialista en Supervisión de Costos Metrados y Valorizaciones",
    "Especialista en Supervisión de la Seguridad Salud en el Trabajo",
    "Especialista de Pre Instalación de Equipamiento Hospitalario",
    "Gerente de Supervisión",
]
# Words that a separator page holds.
_ROLE_WORDS = ["gerente", "jefe", "supervisor", "especialista", "coordinador", "residente", "pre instalacion", "preinstalacion"]
# Phrases that begin a thematic block.
_DELIMITERS = [
    "calificaciones del personal clave",
    "experiencia del personal clave",
    "equipamiento estrategico",
    "documentacion de presentacion",
    "experiencia en la especialidad adicional",
    "sostenibilidad ambiental",
    "integridad en la contratacion",
    "gestion de calidad",
]
# Phrases of pages that are no separators.
_NO_SEPARATOR = [
    "asimismo, manifiesto",
    "me comprometo a prestar",
    "a nombre de la nacion",
    "el rector de la universidad",
    "ha sido incorporado",
    "certificado de trabajo",
    "calificaciones del personal clave",
    "experiencia del personal clave",
]
# Known misreadings of roles and their replacements, applied in this order.
_MISREADINGS = [
    ("supersion", "Supervisión"), ("supervicion", "Supervisión"), ("supervision", "Supervisión"), ("superv ision", "Supervisión"), ("superv1sion", "Supervisión"),
    ("instalaclones", "Instalaciones"), ("instaiaciones", "Instalaciones"), ("instalacionese", "Instalaciones"),
    ("sanltarias", "Sanitarias"), ("sanitarlos", "Sanitarios"),
    ("mecanicas", "Mecánicas"), ("mecamicas", "Mecánicas"), ("mecanlcas", "Mecánicas"),
    ("electricas", "Eléctricas"), ("electrlcas", "Eléctricas"), ("electncas", "Eléctricas"),
    ("segundad", "Seguridad"), ("seguri dad", "Seguridad"), ("salu d", "Salud"), ("salod", "Salud"),
    ("bim", "BIM"), ("b1m", "BIM"),
    ("implementaclon", "Implementación"), ("implementacion", "Implementación"),
    ("conflguraciones", "Configuraciones"), ("configuraciones", "Configuraciones"),
    ("informaclon", "Información"), ("lnformacion", "Información"),
    ("comunlcaciones", "Comunicaciones"), ("comunlcacion", "Comunicación"),
    ("aseguramien to", "Aseguramiento"), ("aseguramienio", "Aseguramiento"), ("calldad", "Calidad"),
    ("metradosv", "Metrados"), ("co stos", "Costos"),
    ("varolizaciones", "Valorizaciones"), ("valonzaciones", "Valorizaciones"), ("valorizaclones", "Valorizaciones"),
    ("teconologicas", "Tecnológicas"), ("arqultectura", "Arquitectura"), ("arqultectonico", "Arquitectónico"),
    ("estructvras", "Estructuras"), ("equipamlento", "Equipamiento"), ("ca1idad", "Calidad"),
]


@dataclass(frozen=True)
class Config:
    least_confidence: float = 0.85
    most_discard: float = 0.35
    legacy_discard: float = 0.20
    #: pages with more lines are routed; with no more, they may be separators
    separator_lines: int = 15
    delimiter_lines: int = 30
    fuzzy_score: float = 80.0
    roles: tuple[str, ...] = tuple(_ROLES)
    role_words: tuple[str, ...] = tuple(_ROLE_WORDS)
    delimiters: tuple[str, ...] = tuple(_DELIMITERS)
    no_separator: tuple[str, ...] = tuple(_NO_SEPARATOR)
    misreadings: tuple[tuple[str, str], ...] = tuple(_MISREADINGS)
    histogram: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 1.0)
    #: pages of a file that one window task holds
    block: int = 512
    extra: dict = field(default_factory=dict)

    def separate_roles(self) -> Config:
        """With the two roles of the merged entry as entries of their own."""
        from dataclasses import replace

        split: list[str] = []
        for r in self.roles:
            cut = r.find("Especialista", 1)
            split += [r[:cut], r[cut:]] if cut > 0 else [r]
        return replace(self, roles=tuple(split))


DEFAULT = Config()
