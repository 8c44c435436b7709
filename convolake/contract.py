"""The data contract: columns, domains, vocabularies, patterns and thresholds. Fixed values."""

from __future__ import annotations

REQUIRED_COLUMNS = (
    "message_id", "conversation_id", "timestamp", "direction", "sender_phone", "sender_name", "message_type",
    "message_body", "status", "channel", "campaign_id", "agent_id", "conversation_outcome", "metadata",
)
METADATA_FIELDS = ("device", "city", "state", "response_time_sec", "is_business_hours", "lead_source")
BRONZE_SCHEMA = ", ".join(f"`{c}` {'timestamp' if c == 'timestamp' else 'string'}" for c in REQUIRED_COLUMNS)
DOMAINS = {
    "direction": ("outbound", "inbound"),
    "message_type": ("text", "image", "audio", "document", "sticker"),
    "status": ("sent", "delivered", "read", "failed"),
    "channel": ("whatsapp",),
}
OUTCOMES = ("venda_fechada", "perdido_preco", "perdido_concorrente", "ghosting", "desistencia_lead", "proposta_enviada", "em_negociacao")
STATUS_PRIORITY = {"failed": 0, "sent": 1, "delivered": 2, "read": 3}
DEDUPE_KEYS = ("conversation_id", "timestamp", "direction", "sender_phone", "message_type", "message_body")
PASSTHROUGH = "bronze_passthrough__"

EMAIL = r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE = r"(?<![A-Za-z0-9_])(?:\+55\s?)?(?:\(?\d{2}\)?\s?)?(?:9?\d{4})-?\d{4}(?![A-Za-z0-9_])"
CPF = r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"
CEP = r"\b\d{5}-?\d{3}\b"
PLATE = r"\b[A-Z]{3}[0-9][A-Z0-9][0-9]{2}\b"
#: Personal-data classes, with Java flags: all look at Unicode letters, e-mails and plates ignore case.
PII = {"email": f"(?iU){EMAIL}", "phone": f"(?U){PHONE}", "cpf": f"(?U){CPF}", "cep": f"(?U){CEP}", "plate": f"(?iU){PLATE}"}
PRICE = r"r\$\s?(\d[\d.]*(?:,\d{2})?)"
OBJECTION = (
    r"\b(caro|cara|preco alto|muito caro|acima do orçamento|acima do orcamento|desconto|parcel[ao]s?|mensalidade|"
    r"cotacao|cotação|orcamento|orçamento)\b"
)
URGENT_STRONG = r"\b(urgente|hoje mesmo|agora|imediat|quanto antes|pra hoje|para hoje|fechar hoje)\b"
URGENT_MODERATE = r"\b(essa semana|esta semana|amanha|amanhã|rapido|rápido|prioridade|preciso logo)\b"
COMPARISON = r"\b(cobriu|cobrou|melhor que|mais barato|mais caro|compar|concorrente|outra seguradora)\b"
EMAIL_DOMAIN = r"\b[A-Z0-9._%+-]+@([A-Z0-9.-]+\.[A-Z]{2,})\b"
COMPETITORS = (
    ("porto_seguro", r"\bporto seguro\b"),
    ("azul_seguros", r"\bazul(?: seguros)?\b"),
    ("bradesco_seguros", r"\bbradesco seguros\b"),
    ("sulamerica", r"\bsul\s?america\b"),
    ("liberty_seguros", r"\bliberty(?: seguros)?\b"),
    ("allianz", r"\ballianz\b"),
    ("hdi_seguros", r"\bhdi(?: seguros)?\b"),
)
CLAIMS = (
    ("enchente", r"\benchente|alagamento\b"),
    ("colisao", r"\bbati\b|\bbatida\b|\bcolis[aã]o\b"),
    ("roubo_furto", r"\broubaram\b|\bfurto\b|\broubo\b"),
    ("perda_total", r"\bperda total\b"),
    ("sinistro_generico", r"\bsinistro\b"),
)
MAKES = (
    "chevrolet", "volkswagen", "fiat", "ford", "toyota", "honda", "hyundai", "jeep", "renault", "nissan",
    "peugeot", "citroen", "mitsubishi", "kia", "bmw", "mercedes", "audi", "volvo", "byd", "gwm",
)
MODELS = (
    "onix", "gol", "civic", "hb20", "corolla", "compass", "hr-v", "hrv", "kwid", "208",
    "toro", "argo", "mobi", "creta", "t cross", "t-cross", "nivus", "tracker", "pulse", "kicks",
)
PROVIDERS = (
    ("gmail", ("gmail.com",)),
    ("outlook", ("hotmail.com", "outlook.com", "live.com", "msn.com")),
    ("yahoo", ("yahoo.com", "yahoo.com.br")),
    ("icloud", ("icloud.com", "me.com")),
    ("uol", ("uol.com.br",)),
    ("bol", ("bol.com.br",)),
    ("terra", ("terra.com.br",)),
)
POSITIVE = (
    r"\bobrigad[oa]s?\b",
    r"\b(valeu|agradeco|agradeco demais)\b",
    r"\b(perfeito|excelente|otim[oa]|maravilha|top)\b",
    r"\b(gostei|bom demais|muito bom)\b",
    r"\b(pode seguir|pode prosseguir|vamos seguir|quero seguir)\b",
    r"\b(vamos fechar|quero fechar|pode fechar|fechado|combinado)\b",
    r"\b(aprovado|aprovada|de acordo|ok pode)\b",
)
NEGATIVE = (
    r"\b(nao tenho interesse|sem interesse|nao quero|nao vou fechar)\b",
    r"\b(cancelar|cancelamento|desist\w*)\b",
    r"\b(reclam\w*|insatisfeit\w*|ruim|pessim\w*|horrivel)\b",
    r"\b(absurdo|um absurdo|surreal)\b",
    r"\b(desconfiad\w*|nao confio|falta de confianca)\b",
    r"\b(enrola\w*|enrolacao|demora demais|muito demorado)\b",
    r"\b(caro demais|muito caro)\b",
)
CLOSED = ("fechado_ganho", "fechado", "apolice_emitida", "venda_realizada", "contrato_assinado")
LOST = ("fechado_perdido", "perdido", "sem_interesse", "cancelado", "nao_convertido")
AUDIENCE_OF = {
    "cliente_pos_sinistro": "retencao_pos_sinistro",
    "cotador_comparador": "oferta_competitiva",
    "lead_engajado_com_dados": "close_comercial",
    "lead_frio": "nutricao_basica",
}
SEVERITY = {"nenhuma": 0, "baixa": 0, "leve": 1, "fraco": 1, "moderada": 2, "moderado": 2, "forte": 3, "alta": 3}
MACRO_DIMENSIONS = (
    "persona_profile", "audience_segment", "dominant_email_provider", "lead_temperature", "engagement_bucket",
    "conversation_sentiment_label", "closure_outcome_group", "competitor_pressure_level", "price_objection_intensity",
    "commercial_urgency_signal", "intent_stage",
)
FLAGS = ("email", "phone", "cpf", "cep", "plate")
GOLD_DOMAINS = {
    "engagement_bucket": ("lead_frio", "curta", "media", "longa"),
    "lead_temperature": ("frio", "morno", "quente"),
    "price_sensitivity": ("baixa", "alta"),
    "contact_readiness": ("baixa", "media", "alta"),
    "intent_stage": ("descoberta_inicial", "pesquisa_mercado", "cotacao_ativa", "pos_sinistro"),
    "risk_signal": ("baixo", "medio", "alto"),
    "persona_profile": tuple(AUDIENCE_OF),
    "audience_segment": tuple(AUDIENCE_OF.values()),
    "closure_outcome_group": ("aberto", "fechado", "perdido"),
    "response_latency_band": ("rapida", "moderada", "lenta", "sem_evidencia"),
    "price_objection_intensity": ("nenhuma", "leve", "forte"),
    "commercial_urgency_signal": ("nenhuma", "moderada", "alta"),
    "competitor_pressure_level": ("nenhuma", "leve", "alta"),
    "conversation_sentiment_label": ("positivo", "neutro", "negativo", "sem_evidencia"),
    "conversation_sentiment_support": ("fraco", "moderado", "forte", "sem_evidencia"),
}
