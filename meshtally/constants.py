"""Fixed values of the electoral and address domains (not tunable)."""

# --- fixed values: codes that stand for a vote without a candidate
BLANK_CODE, NULL_CODE, ANNULLED_CODE = "95", "96", "97"
PARTY_LIST_SEQ, EMPTY_SEQ = "-3", "-1"
BLANK_NAME, NULL_NAME = "VOTO EM BRANCO", "VOTO NULO"
BLANK_SPELLINGS = ["VOTO BRANCO", "VOTO EM BRANCO"]
ORDINARY_ELECTION = "2"
ABROAD = "ZZ"

# --- fixed values: office codes, and the scope in which a ballot number is unique
OFFICES = {1: "PRESIDENTE", 3: "GOVERNADOR", 5: "SENADOR", 6: "DEPUTADO FEDERAL",
           7: "DEPUTADO ESTADUAL", 8: "DEPUTADO DISTRITAL", 11: "PREFEITO", 13: "VEREADOR"}
NATIONAL_OFFICES, MUNICIPAL_OFFICES = [1], [11, 13]
OFFICE_KIND = {1: "federal", 3: "estadual", 5: "estadual", 6: "estadual",
               7: "estadual", 11: "municipal", 13: "municipal"}
SENATOR = 5

# --- fixed values: enumerations of the ballot report and of the vote record
REPORT_PHASES = {1: "simulado", 2: "oficial", 3: "treinamento"}
REPORT_VOTE_TYPES = {1: "nominal", 2: "branco", 3: "nulo", 4: "legenda", 5: "cargo_sem_candidato"}
RECORD_VOTE_TYPES = {1: "legenda", 2: "nominal", 3: "branco", 4: "nulo", 5: "brancoAposSuspensao",
                     6: "nuloAposSuspensao", 7: "nuloPorRepeticao", 8: "nuloCargoSemCandidato",
                     9: "nuloAposSuspensaoCargoSemCandidato"}

# --- fixed values: residences in the address file, country box, mean earth radius
RESIDENCE_KINDS = ["1", "2"]
LAT_BOX, LON_BOX = (-34.0, 5.3), (-74.0, -34.7)
EARTH_RADIUS_M = 6_371_000.0
METRIC_CRS = "EPSG:5880"

# --- fixed values: candidacy situations that never went to the ballot
VOID_SITUATIONS = ["#NULO", "#NE", ""]

# --- fixed values: state acronyms and names
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapá", "BA": "Bahia", "CE": "Ceará",
    "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás", "MA": "Maranhão",
    "MG": "Minas Gerais", "MS": "Mato Grosso do Sul", "MT": "Mato Grosso", "PA": "Pará",
    "PB": "Paraíba", "PE": "Pernambuco", "PI": "Piauí", "PR": "Paraná", "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte", "RO": "Rondônia", "RR": "Roraima", "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina", "SE": "Sergipe", "SP": "São Paulo", "TO": "Tocantins",
}

# --- fixed values: official national totals for president (year, round, name part, votes)
OFFICIAL_TOTALS = [
    (2018, "1", "BOLSONARO", 49_277_010), (2018, "1", "HADDAD", 31_342_051),
    (2018, "2", "BOLSONARO", 57_797_847), (2018, "2", "HADDAD", 47_040_906),
    (2022, "1", "LULA", 57_259_504), (2022, "1", "BOLSONARO", 51_072_345),
    (2022, "2", "LULA", 60_345_999), (2022, "2", "BOLSONARO", 58_206_354),
]

# --- fixed values: tolerances of the gates
MIN_JOIN_RATE = 0.5
SAME_BUILDING_M = 50.0
REJECT_LIMIT, FIRST_REPORTS, FIRST_REJECT_LIMIT = 0.005, 200, 0.5
MISSING_LIMIT, VOTE_SLACK, VOTE_SLACK_SHARE = 0.0005, 10, 0.0001
PCT_SLACK, SHARE_SLACK, SHARE_SLACK_PER_ITEM = 0.5, 0.02, 0.0005
MAX_CANDIDATES, TOP_DEPUTIES = 40, 3
FAR_M, VERY_FAR_M = 5_000.0, 25_000.0
DIVERGENCE_M, SUSPECT_FACTOR = 5_000.0, 3.0
PUBLIC_KEY_FORMAT = r"^\d{1,4}-\d{1,5}$"
