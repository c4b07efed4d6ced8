"""Names and fixed values of a profile: which columns, categories and words it uses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ProfileSpec:
    """Everything about a domain that the operators take as a parameter."""

    raw_columns: Mapping[str, str]
    category_map: Mapping[str, str]
    ignored_categories: tuple[str, ...]
    main_activities: tuple[str, ...]
    context: tuple[str, ...]
    nothing_word: str
    zero_marks: tuple[str, ...] = ("-",)
    null_marks: tuple[str, ...] = ("...", "..", "X")
    quantiles: tuple[float, float] = (0.33, 0.66)
    min_positives: int = 3
    entity: str = "id_municipio"
    name: str = "nome_municipio"
    group: str = "sigla_uf"
    period: str = "ano"
    activity: str = "atividade"
    value: str = "valor"
    band_prefix: str = "perfil_"
    specialty: str = "especializacao"
    count: str = "n_atividades"
    present: str = "atividades_presentes"
    text: str = "tags"
    none_word: str = "sem_"
    low_word: str = "baixa_"
    mid_word: str = "media_"
    high_word: str = "alta_"
    present_word: str = "presente_"
    specialty_word: str = "especializado_em_"
    activities: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if not self.activities:
            object.__setattr__(self, "activities", tuple(dict.fromkeys(self.category_map.values())))

    def observed(self, columns) -> list[str]:
        """The declared activities found among ``columns``, in declared order."""
        return [a for a in self.activities if a in columns]


# Column names, category names and words of the livestock survey.
LIVESTOCK = ProfileSpec(
    raw_columns={
        "D1C": "id_municipio_str",
        "D1N": "nome_municipio_uf",
        "D2C": "ano_str",
        "D4C": "id_tipo_rebanho",
        "D4N": "tipo_rebanho_raw",
        "V": "valor_str",
    },
    category_map={
        "Bovino": "bovinocultura",
        "Bubalino": "bubalinocultura",
        "Equino": "equinocultura",
        "Suíno - total": "suinocultura",
        "Caprino": "caprinocultura",
        "Ovino": "ovinocultura",
        "Galináceos - total": "avicultura",
        "Codornas": "coturnicultura",
    },
    ignored_categories=(
        "Suíno - matrizes de suínos",
        "Suíno - matrizes desuínos",
        "Galináceos - galinhas",
    ),
    main_activities=("bovinocultura", "suinocultura", "avicultura", "ovinocultura", "caprinocultura"),
    context=("nome_regiao", "sigla_uf", "nome_mesorregiao"),
    nothing_word="sem_producao_pecuaria",
)
