"""Reference data: fixed values that results rest on, stated as they are. Lookups go by match key (accents folded, lower)."""

from __future__ import annotations

import unicodedata

#: States by code.
STATES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapá", "AM": "Amazonas", "BA": "Bahia", "CE": "Ceará", "DF": "Distrito Federal",
    "ES": "Espírito Santo", "GO": "Goiás", "MA": "Maranhão", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul", "MG": "Minas Gerais",
    "PA": "Pará", "PB": "Paraíba", "PR": "Paraná", "PE": "Pernambuco", "PI": "Piauí", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul", "RO": "Rondônia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "São Paulo", "SE": "Sergipe", "TO": "Tocantins",
}
#: Other spellings of states.
STATE_SPELLINGS = {"minas": "Minas Gerais", "rio grande sul": "Rio Grande do Sul", "mato grosso sul": "Mato Grosso do Sul", "brasilia": "Distrito Federal", "bsb": "Distrito Federal"}
#: Cities in their right spelling.
CITIES = [
    "São Paulo", "Rio de Janeiro", "Belo Horizonte", "Brasília", "Porto Alegre", "Curitiba", "Florianópolis", "São José dos Campos",
    "São Bernardo do Campo", "Santo André", "São Caetano do Sul", "Ribeirão Preto", "São José do Rio Preto", "Campinas", "Vitória", "Recife",
    "Fortaleza", "Salvador", "Goiânia", "Belém", "Manaus", "São Luís", "João Pessoa", "Teresina", "Natal", "Campo Grande", "Maceió", "Aracaju",
    "Cuiabá", "Porto Velho", "Boa Vista", "Rio Branco", "Macapá", "Palmas",
]
#: Market sectors.
MARKETS = ["EdTech", "FinTech", "HealthTech", "AgTech", "PropTech", "InsurTech", "MarTech", "FoodTech", "HRTech", "LegalTech", "RetailTech", "ConstruTech"]
#: Investment stages.
STAGES = ["Pré-Seed", "Seed", "Série A", "Série B", "Série C", "Crescimento"]
#: Enumerations of forms.
MARITAL = {
    "SOLTEIRO": "Solteiro", "SOLTEIRA": "Solteira", "CASADO": "Casado", "CASADA": "Casada", "DIVORCIADO": "Divorciado", "DIVORCIADA": "Divorciada",
    "VIÚVO": "Viúvo", "VIÚVA": "Viúva", "SEPARADO": "Separado", "SEPARADA": "Separada", "UNIÃO ESTÁVEL": "União Estável", "UNIAO ESTAVEL": "União Estável",
    "SINGLE": "Solteiro", "MARRIED": "Casado", "DIVORCED": "Divorciado", "WIDOWED": "Viúvo", "SEPARATED": "Separado",
}
GENDER = {
    "MASCULINO": "Masculino", "FEMININO": "Feminino", "M": "Masculino", "F": "Feminino", "MALE": "Masculino", "FEMALE": "Feminino", "HOMEM": "Masculino",
    "MULHER": "Feminino", "OUTRO": "Outro", "OTHER": "Outro", "NÃO BINÁRIO": "Não Binário", "NAO BINARIO": "Não Binário", "NON-BINARY": "Não Binário",
}
EDUCATION = {
    "FUNDAMENTAL": "Ensino Fundamental", "ENSINO FUNDAMENTAL": "Ensino Fundamental", "MÉDIO": "Ensino Médio", "ENSINO MÉDIO": "Ensino Médio",
    "ENSINO MEDIO": "Ensino Médio", "SUPERIOR": "Ensino Superior", "ENSINO SUPERIOR": "Ensino Superior", "GRADUAÇÃO": "Graduação", "GRADUACAO": "Graduação",
    "PÓS-GRADUAÇÃO": "Pós-Graduação", "POS-GRADUACAO": "Pós-Graduação", "MESTRADO": "Mestrado", "DOUTORADO": "Doutorado", "MBA": "MBA", "TÉCNICO": "Técnico", "TECNICO": "Técnico",
}
#: Months.
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
#: Words that stay in lower case inside names, in the list of six and the list of eleven.
PREPOSITIONS = {"short": ["de", "da", "do", "das", "dos", "e"], "long": ["de", "da", "do", "das", "dos", "e", "em", "na", "no", "para", "por"]}
TITLES = ["DR", "DRA", "SR", "SRA", "PROF"]
#: Legal forms of companies.
LEGAL_FORMS = ["LTDA", "S.A.", "S/A", "SA", "ME", "EPP", "EIRELI", "MEI"]
#: Keywords, in order; the first group that has one wins.
JOB_LEVELS = [
    ("C-Level", ["ceo", "presidente", "chairman", "fundador"]), ("Diretoria", ["diretor", "vp", "vice-presidente"]), ("Gerência", ["gerente", "manager", "head"]),
    ("Coordenação", ["coordenador", "supervisor", "líder"]), ("Especialista", ["analista", "especialista"]),
]
SEGMENTS = [
    ("TECNOLOGIA", ["tech", "tecnologia", "software", "digital"]), ("CONSTRUCAO", ["constru", "engenharia", "obra"]), ("EDUCACAO", ["educa", "ensino", "escola"]),
    ("SAUDE", ["saude", "medic", "hospital"]), ("FINANCAS", ["financ", "invest", "banco"]), ("COMERCIO", ["comercio", "venda", "varejo"]),
]
SECTORS = [
    ("tecnologia", ["tech", "software", "sistemas", "digital", "it"]), ("saúde", ["saude", "health", "clinica", "hospital", "medical"]),
    ("educação", ["edu", "escola", "ensino", "training"]), ("varejo", ["store", "loja", "comercio", "shop"]),
    ("serviços", ["consultoria", "services", "solutions"]), ("indústria", ["industria", "factory", "manufatura"]),
]
#: Revenue bands with their ends, headcount bands in order.
REVENUE = [
    ("até 1 milhão", 0.0, 1e6), ("1 milhão a 10 milhões", 1e6, 1e7), ("10 milhões a 50 milhões", 1e7, 5e7),
    ("50 milhões a 100 milhões", 5e7, 1e8), ("acima de 100 milhões", 1e8, 1e9),
]
HEADCOUNT = ["1-10", "11-50", "51-200", "201-500", "501-1000", "1001-5000", "5000+"]
#: Providers of personal mail.
PERSONAL_MAIL = ["gmail.com", "hotmail.com", "yahoo.com", "yahoo.com.br", "outlook.com", "icloud.com", "bol.com.br", "uol.com.br", "terra.com.br", "live.com"]
#: Standard names of fields and what exports call them.
SYNONYMS = {
    "nome_completo": ["nome completo", "nome", "full name", "name"],
    "cpf": ["cpf:", "cpf", "documento"],
    "rg": ["rg:", "rg", "identidade"],
    "email": ["email", "e-mail", "email principal", "deixe aqui seu email principal"],
    "telefone": ["whatsapp", "telefone", "celular", "phone", "tel"],
    "data_nascimento": ["aniversário", "nascimento", "birthday", "data de nascimento"],
    "endereco": ["endereço", "endereco", "address", "endereço residencial completo:"],
    "cidade_estado": ["cidade e estado", "cidade", "city", "localização"],
    "empresa": ["empresa", "company", "empresa atual", "qual o nome da sua empresa atual?"],
    "cargo": ["cargo", "position", "cargo atual", "qual o seu cargo atual?"],
    "segmento": ["segmento", "segment", "segmento de atuação", "qual o segmento de atuação da empresa?"],
    "faixa_funcionarios": ["funcionários", "employees", "faixa de funcionários"],
    "faixa_faturamento": ["faturamento", "revenue", "faixa de faturamento"],
    "linkedin": ["linkedin", "linkedin:", "perfil linkedin"],
    "objetivos": ["objetivos", "o que você busca", "expectations", "goals"],
    "dores_necessidades": ["dores", "necessidades", "pain points", "needs"],
    "id_unico": ["#", "id", "codigo", "identifier"],
    "data_inscricao": ["submit date", "data inscricao", "inscription date"],
    "autorizacao_imagem": ["autorizo", "autorizacao", "consent"],
    "tipo_nota_fiscal": ["emissão de nota fiscal", "tipo nota", "invoice type"],
    "cnpj": ["cnpj:", "cnpj", "company document"],
}


def fold(text: str) -> str:
    """Without accents, in lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def accent_table() -> tuple[str, str]:
    """Accented letters of Latin-1 and Latin Extended-A with their plain letters, for translate."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x180) if unicodedata.normalize("NFKD", chr(c))[0] != chr(c) and unicodedata.normalize("NFKD", chr(c))[0].isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def dimension(name: str) -> dict[str, str]:
    """Match key -> standard value, of states, cities, markets or stages."""
    if name == "states":
        return {fold(k): v for k, v in STATES.items()} | {fold(v): v for v in STATES.values()} | STATE_SPELLINGS
    return {fold(v): v for v in {"cities": CITIES, "markets": MARKETS, "stages": STAGES}[name]}
