"""A small register: every row is there for one rule."""

ESTADOS = [
    ("11", "RO", "Rondônia", "norte"), ("29", "BA", "Bahia", "Nordeste"), ("53", "DF", "Distrito Federal", "centro_oeste"),
    ("35", "SP", "São Paulo", "sudeste"), ("43", "RS", "Rio Grande do Sul", "sul"), ("98", "XX", "Longe", "litoral"),
]
MUNICIPIOS = [
    ("1100205", "Porto Velho", "-8,76", "-63,9", "1", "11"), ("2900001", "Vila", "-12,5", None, "0", "29"),
    ("3500001", "Sem Latitude", None, "-46,1", "0", "35"), ("7700000", "Sem Estado", "1,0", "1,0", "0", "77"),
]
PROPONENTES = [("A1", "Prefeitura A"), ("A1", "  Prefeitura A "), ("B2", "Instituto B"), ("D4", "Sem Convenio")]


def proposta(key, town, who, year, state, name):
    return (key, town, "20", "Ministério", "Municipal", "21", "Agência", "CONVENIO", who, "Obra; com \"aspas\"\ne linha", year, state, name)


PROPOSTAS = [
    proposta("1", "1100205", "A1", "2010", "RO", "Porto Velho"),
    proposta("2", "9999999", "A1", "2011", "SP", "Outra"),
    proposta("3", None, "B2", "2012", "ZZ", "Nenhures"),
    proposta("4", "2900001", "C3", "2012", "BA", "Vila"),
]


def convenio(number, proposal, signed, status, active, published, start, end, total):
    return (number, proposal, signed, status, active, published, start, end, None, total, "900,00", "100,50")


CONVENIOS = [
    convenio("700427", "1", "05/01/2009", "Em execução", "Não", "06/01/2009", "10/01/2009", "31/12/2010", "1000,50"),
    convenio("774717", "2", "01/02/2011", None, "Sim", "02/02/2011", "05/02/2011", "31/12/2011", "2000,00"),
    convenio("704101", "2", "02/02/2011", "Inadimplente", "NÃO", "02/02/2011", "06/02/2011", "31/12/2011", "3000,00"),
    convenio("756498", "3", "03/02/2012", "Prestação de Contas Rejeitada", "Sim", "04/02/2012", "07/02/2012", "31/12/2013", "4000,00"),
    convenio("400", "4", "03/02/2012", "Em execução", "Sim", "04/02/2012", "07/02/2012", "31/12/2013", "1,00"),
    convenio("500", "1", None, "Em execução", "Sim", "04/02/2012", "07/02/2012", "31/12/2013", "1,00"),
    convenio("600", "1", "03/02/2012", "Em execução", "Sim", None, "07/02/2012", "31/12/2013", "1,00"),
]
EMENDAS = [
    ("1", "7", "Ana", "INDIVIDUAL", "100,00"), ("1", "8", "Zeca", "INDIVIDUAL", "100,00"), ("1", None, "Ninguem", "INDIVIDUAL", "1,00"),
    ("2", "9", None, None, None), ("2", "10", "Bia", "BANCADA", "50,00"), ("4", "11", "Caio", "BANCADA", "70,00"),
]
DESEMBOLSOS = [
    ("1", "774717", "01/03/2011", "10,00"), ("2", "774717", "01/03/2011", "10,00"), ("3", "774717", None, "5,00"),
    ("4", "774717", "02/03/2011", "0,00"), ("5", "999", "02/03/2011", "7,00"), ("6", "774717", "24/06/1900", "3,00"),
    ("7", "774717", "02/03/2011", None),
]
CONTRAPARTIDAS = [
    ("704101", "30/12/2000", "20,00"), ("704101", "05/02/2012", "0,00"), ("704101", "05/02/2012", "21,00"), ("999", "05/02/2012", "1,00"),
]
TRIBUTOS = [
    ("700427", "30/09/2007", "1,00"), ("700427", "15/03/0209", "2,00"), ("756498", None, "3,00"),
    ("774717", None, "0,00"), ("999", "01/01/2020", "4,00"),
]
PAGAMENTOS = [
    ("1", "756498", "F1", "FIRMA UM", "09/12/2012", "11,00"), ("2", "756498", "F1", "FIRMA UM", "10/01/2011", "12,00"),
    ("3", "756498", "F1", "FIRMA UM", "03/09/1985", "13,00"), ("4", "756498", "F2", "firma dois", "01/01/2013", "14,00"),
    ("5", "756498", "F3", "FIRMA TRES", "01/01/2013", "0,00"), ("6", "756498", None, None, "01/01/2013", "15,00"),
    ("7", "756498", "F4", "FIRMA QUATRO", None, "16,00"), ("8", "756498", "F5", "FIRMA CINCO", "01/02/2013", "17,00"),
    (None, "756498", "F6", "FIRMA SEIS", "01/02/2013", "18,00"), ("9", "999", "F7", "FIRMA SETE", "01/02/2013", "19,00"),
]
OBTV = [
    ("8", "B1", "Benef Um", "Material", "8,50"), ("8", "B2", "Benef Dois", "Material", "0,00"), ("8", None, "Ninguem", "Material", "1,00"),
    (None, "B3", "Benef Tres", "Material", "1,00"), ("77", "B4", "Sem Pagamento", "Material", "1,00"),
]


def licitacao(key, modality, process, kind, status="Concluída", value="10,00", grant="756498"):
    return (key, grant, modality, process, kind, status, value)


LICITACOES = [
    licitacao("1", "12", None, "Presencial - Menor Preço"),
    licitacao("2", None, "Eletrônica", "ELETRÔNICO - Registro de Preço"),
    licitacao("3", "34", "5", "eletronico registro de preco menor valor"),
    licitacao("4", "Convite", None, "Melhor tecnica"),
    licitacao("5", "Convite", None, "Técnica e Preco", None, None),
    licitacao("6", "Convite", None, "123"),
    licitacao("7", "Convite", None, "menor preço e melhor técnica"),
    licitacao("8", "Convite", None, None),
    licitacao("8", "CONVITE", None, None),
    licitacao("9", "Convite", None, "LICITACAO_INTERNACIONAL", grant="999"),
]
TABLES = {
    "estados": ESTADOS, "municipios": MUNICIPIOS, "proponentes": PROPONENTES, "propostas": PROPOSTAS, "convenios": CONVENIOS,
    "emendas": EMENDAS, "desembolsos": DESEMBOLSOS, "contrapartidas": CONTRAPARTIDAS, "tributos": TRIBUTOS,
    "pagamentos": PAGAMENTOS, "obtv": OBTV, "licitacoes": LICITACOES,
}
