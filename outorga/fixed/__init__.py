"""Word lists, lookup tables and sentinels the mart must reproduce exactly."""

# Texts the raw reader takes as null, for text columns too.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Characters removed from both ends of every text value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Sentinels.
UNSPECIFIED_M = "#(NÃO ESPECIFICADO)"
UNSPECIFIED_F = "#(NÃO ESPECIFICADA)"
UNDEFINED_M = "#(INDEFINIDO)"
UNDEFINED_F = "#(INDEFINIDA)"
NOT_APPLICABLE = "#(NÃO APLICÁVEL)"
NO_MEMBER = "NAO APLICAVEL"
NO_MEMBER_ID = -1
YES, NO = "SIM", "NAO"

# Region name -> two-letter code.
REGION_CODES = {
    "NORTE": "NO",
    "NORDESTE": "NE",
    "CENTRO_OESTE": "CO",
    "SUDESTE": "SE",
    "SUL": "SU",
}

# Region -> states.
REGION_STATES = {
    "NORTE": ["AP", "PA", "RR", "AM", "RO", "TO", "AC"],
    "NORDESTE": ["MA", "SE", "PI", "PE", "RN", "PB", "BA", "CE", "AL"],
    "CENTRO_OESTE": ["GO", "MT", "MS", "DF"],
    "SUDESTE": ["SP", "RJ", "ES", "MG"],
    "SUL": ["RS", "PR", "SC"],
}

MONTHS = [
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]
WEEKDAYS = [
    "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sabado", "domingo",
]

# Statuses.
LIVE_STATUS = "em execução"
FAILED_STATUSES = ["Prestação de Contas Rejeitada", "Inadimplente", "Convênio Rescindido"]

# Last five characters of a tax date -> year it stands for.
BAD_YEAR_SUFFIXES = {
    "/0001": 2001, "/0009": 2009, "/0010": 2010, "/0011": 2011,
    "/0200": 2010, "/0201": 2010, "/0209": 2009, "/0210": 2010,
}

# Wrong dates of single grants: leg, grant, wrong date, right date.
DATE_FIXES = """
P 756498 03/09/1985 03/09/2012
P 703184 13/01/2001 13/01/2010
P 731964 19/01/2001 19/01/2011
P 702011 14/02/2001 14/02/2011
P 726717 21/02/2001 21/02/2011
P 720576 07/04/2001 07/04/2010
P 752802 19/08/2001 19/08/2011
P 702821 01/09/2001 01/09/2011
P 716075 13/02/2002 13/02/2012
P 703060 14/09/2002 14/09/2012
P 723528 16/10/2002 16/10/2012
P 702387 31/12/2004 31/12/2010
P 702387 31/12/2003 31/12/2009
P 717464 22/06/2006 22/06/2010
P 704192 24/12/2006 22/06/2010
P 732451 17/05/2007 17/05/2010
P 701723 31/05/2007 31/05/2011
P 715596 16/06/2007 16/06/2010
P 705156 06/11/2007 06/11/2009
P 769286 03/06/2031 03/06/2013
P 772002 30/12/2004 30/12/2014
P 751725 21/09/2001 21/09/2011
P 733707 18/11/2001 18/11/2011
T 700427 30/09/2007 30/09/2009
T 700427 01/09/8009 01/09/2009
T 702429 10/06/2000 10/06/2010
T 702429 10/06/2001 10/06/2010
T 703330 08/03/2029 08/03/2009
T 704400 05/10/2209 05/10/2009
T 704419 30/11/1975 30/11/2010
T 705792 25/04/2002 25/04/2010
T 707660 18/02/2001 18/02/2012
T 713794 07/06/2001 07/06/2011
T 717289 20/05/2044 20/05/2012
T 718214 15/04/2001 15/04/2010
T 721788 20/01/2005 20/01/2011
T 727573 30/07/2007 30/07/2010
T 735447 22/10/1984 22/10/2013
T 744662 01/09/2001 01/09/2011
T 750595 17/11/2001 17/11/2011
T 750893 23/01/2047 23/01/2017
T 754694 12/12/2001 12/12/2011
T 755872 25/11/1979 25/11/2011
T 758189 30/10/1968 30/10/2012
T 769286 10/04/2031 10/04/2013
T 770959 03/11/2004 03/11/2014
T 749284 01/01/2001 01/01/2011
D 774717 24/06/1900 24/06/2014
C 704101 30/12/2000 30/12/2009
C 721720 01/06/2001 01/06/2011
C 719808 05/02/2003 05/02/2013
"""


def date_fixes() -> list[tuple[str, int, str, str]]:
    rows = (line.split() for line in DATE_FIXES.strip().splitlines())
    return [(leg, int(grant), wrong, right) for leg, grant, wrong, right in rows]
