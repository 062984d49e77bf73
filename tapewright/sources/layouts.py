"""Record layouts of the sources; others are read from a table with ``fields_of``."""

from __future__ import annotations

from tapewright.functions.fields import Field, field_of


def layout(text: str, common: str = "string") -> list[Field]:
    """Fields of a layout written as ``name``, ``name type``, with a width or an element's path after it; one a line."""
    found = []
    for line in filter(None, map(str.strip, text.splitlines())):
        name, *more = line.split(maxsplit=1)
        kind, _, last = (more[0] if more else common).rpartition(" ")
        if last.isdigit():
            found.append(field_of(name, kind, width=int(last)))
        elif kind and "=" not in last:
            found.append(field_of(name, kind, tag=last))
        else:
            found.append(field_of(name, more[0] if more else common))
    return found


# fixed values: field names and types of the sources
TRADES = [
    Field("refdate", "date"),
    Field("symbol"),
    Field("update_action", "integer"),
    Field("traded_price", "numeric", decimal=","),
    Field("traded_quantity", "numeric"),
    Field("trade_time", "integer"),
    Field("trade_id", "numeric"),
    Field("trade_session_id", "integer"),
    Field("trade_date", "datetime", format="%Y-%m-%d"),
    Field("buyer_code", "numeric"),
    Field("seller_code", "numeric"),
]
FX_BULLETINS = [
    Field("refdate", "datetime", format="%Y-%m-%d %H:%M:%S.%f"),
    Field("currency"),
    Field("bulletin_type"),
    Field("bid", "numeric"),
    Field("ask", "numeric"),
    Field("parity_bid", "numeric"),
    Field("parity_ask", "numeric"),
    Field("downloaded_at", "datetime"),
]
MACRO_SERIES = [
    Field("refdate", "date", format="%d/%m/%Y"),
    Field("code", "integer"),
    Field("value", "numeric"),
    Field("downloaded_at", "datetime"),
]
INDEX_MEMBERS = [
    Field("symbol"),
    Field("corporation_name"),
    Field("specification_code"),
    Field("indexes"),
    Field("refdate", "date"),
    Field("update_date", "date"),
    Field("start_month", "integer"),
    Field("end_month", "integer"),
    Field("year", "integer"),
]
INDEX_MONTHS = [
    Field("day", "integer"),
    *[Field(f"month{k:02d}", "numeric", thousands=".", decimal=",") for k in range(1, 13)],
    Field("year", "integer"),
    Field("index"),
]

# fixed values: names, types and widths of the records; in text files every record has the widths' sum of letters
PRICE_HISTORY = layout("""
    regtype string 2
    refdate date(format='%Y%m%d') 8
    bdi_code integer 2
    symbol string 12
    instrument_market integer 3
    corporation_name string 12
    specification_code string 10
    days_to_settlement integer 3
    trading_currency string 4
    open numeric(dec=2) 13
    high numeric(dec=2) 13
    low numeric(dec=2) 13
    average numeric(dec=2) 13
    close numeric(dec=2) 13
    best_bid numeric(dec=2) 13
    best_ask numeric(dec=2) 13
    trade_quantity integer 5
    traded_contracts integer 18
    volume numeric(dec=2) 18
    strike_price numeric(dec=2) 13
    strike_price_adjustment_indicator string 1
    maturity_date date(format='%Y%m%d') 8
    allocation_lot_size integer 7
    strike_price_in_points numeric(dec=6) 13
    isin string 12
    distribution_id integer 3
""")
REGISTERED_CONTRACTS = layout("""
    id_transacao integer 6
    compl_transacao integer 3
    tipo_registro integer 2
    data_referencia date(format='%Y%m%d') 8
    cod_mercadoria string 3
    tipo_mercado string 1
    serie string 4
    tipo_opcao string 1
    tipo_exercicio string 1
    data_vencimento date(format='%Y%m%d') 8
    data_inicio_negociacao date(format='%Y%m%d') 8
    data_inicio_exercicio date(format='%Y%m%d') 8
    data_limite_negociacao date(format='%Y%m%d') 8
    data_limite_abertura_posicoes date(format='%Y%m%d') 8
    preco_exercicio numeric 15
    num_casas_decimais integer 1
    cod_viva_voz string 20
    cod_gts string 20
    cod_isin string 12
    contr_objeto_vencimento string 4
    tipo_cotacao string 1
    tipo_mercadoria string 1
    variacao_minima numeric 15
    indicador_opcao_ajuste string 1
    indicador_mercadoria_internacional string 1
    cod_moeda string 2
    indicador_operacao_estruturada string 1
    num_dias_saques integer 5
    num_dias_corridos integer 5
    num_dias_uteis integer 5
    descricao_mercadoria string 15
""")
ECONOMIC_INDICATORS = layout("""
    id_transacao integer 6
    compl_transacao integer 3
    tipo_registro integer 2
    data_geracao_arquivo date(format='%Y%m%d') 8
    grupo_indicador string 2
    cod_indicador string 25
    valor_indicador integer 25
    num_casas_decimais integer 2
    reserva string 36
""")
DERIVATIVES_DAILY = layout("""
    id_transacao integer 6
    compl_transacao integer 3
    tipo_registro integer 2
    data_geracao_arquivo date(format='%Y%m%d') 8
    tipo_negociacao string 2
    cod_mercadoria string 3
    cod_mercado string 1
    tipo_serie string 1
    serie string 4
    hora_criacao_registro time(format='%H%M%S') 6
    data_vencimento date(format='%Y%m%d') 8
    preco_exercicio numeric 13
    tamanho_contr numeric(dec=7) 13
    volume_real integer 13
    volume_dolar integer 13
    qtd_contr_aberto integer 8
    qtd_negocios integer 8
    qtd_contr integer 8
    qtd_contr_ult_compra integer 5
    sinal_ult_oferta_compra string 1
    cot_ult_oferta_compra numeric 8
    qtd_contr_ult_oferta_compra integer 5
    sinal_ult_oferta_venda string 1
    cot_ult_oferta_venda numeric 8
    sinal_cot_primeiro_negocio string 1
    cot_primeiro_negocio numeric 8
    sinal_cot_menor_negocio string 1
    cot_menor_negocio numeric 8
    sinal_cot_maior_negocio string 1
    cot_maior_negocio numeric 8
    sinal_cot_med_negocios string 1
    cot_med_negocios numeric 8
    qtd_contr_ult_negocio integer 5
    sinal_cot_ult_negocio string 1
    cot_ult_negocio numeric 8
    hora_ult_negocio time(format='%H%M%S') 6
    data_ult_negocio date(format='%Y%m%d') 8
    sinal_cot_ult_negocio_anterior string 1
    cot_ult_negocio_anterior numeric 8
    sinal_cot_fechamento string 1
    cot_fechamento numeric 8
    sinal_cot_ajuste string 1
    cot_ajuste numeric 13
    situacao_ajuste string 1
    sinal_cot_ajuste_anterior string 1
    cot_ajuste_anterior numeric 13
    situacao_ajuste_anterior string 1
    valor_ajuste_contr numeric(dec=2) 13
    volume_exercido_real integer 13
    volume_exercido_dolar integer 13
    qtd_negocios_exercidos integer 8
    qtd_contr_exercidos integer 8
    num_casas_decimais_2 integer 1
    num_casas_decimais integer 1
    perc_oscilacao numeric(dec=1) 8
    sinal_oscilacao string 1
    valor_diferenca numeric 8
    sinal_diferenca string 1
    valor_equivalencia numeric(dec=2) 8
    valor_dolar_anterior numeric(dec=7) 13
    valor_dolar numeric(dec=7) 13
    valor_delta numeric(dec=7) 9
    num_dias_saques integer 5
    num_dias_corridos integer 5
    num_dias_uteis integer 5
    data_vencimento_objeto string 4
    margem_clientes numeric(dec=2) 13
    margem_hedgers numeric(dec=2) 13
    data_inicio_entrega date(format='%Y%m%d') 8
    sequencia_vencimento integer 3
    cod_viva_voz string 20
    cod_gts string 20
    canais_negociacao string 1
    ref_negocios string 4
    data_limite_negociacao date(format='%Y%m%d') 8
    data_liquidacao_financeira date(format='%Y%m%d') 8
    sinal_limite_min_negociacao string 1
    limite_min_negociacao numeric 13
    sinal_limite_max_negociacao string 1
    limite_max_negociacao numeric 13
""")

# fixed values: names, types and element paths of the price reports (XML)
PRICE_REPORTS = layout("""
    refdate date TradDt/Dt
    symbol string SctyId/TckrSymb
    security_id string FinInstrmId/OthrId/Id
    security_proprietary integer FinInstrmId/OthrId/Tp/Prtry
    security_market string FinInstrmId/PlcOfListg/MktIdrCd
    volume numeric FinInstrmAttrbts/NtlFinVol
    open_interest numeric FinInstrmAttrbts/OpnIntrst
    traded_contracts numeric FinInstrmAttrbts/FinInstrmQty
    best_ask_price numeric FinInstrmAttrbts/BestAskPric
    best_bid_price numeric FinInstrmAttrbts/BestBidPric
    open numeric FinInstrmAttrbts/FrstPric
    low numeric FinInstrmAttrbts/MinPric
    high numeric FinInstrmAttrbts/MaxPric
    close numeric FinInstrmAttrbts/LastPric
    average numeric FinInstrmAttrbts/TradAvrgPric
    regular_transactions_quantity integer FinInstrmAttrbts/RglrTxsQty
    regular_traded_contracts integer FinInstrmAttrbts/RglrTraddCtrcts
    regular_volume numeric FinInstrmAttrbts/NtlRglrVol
    nonregular_transactions_quantity integer FinInstrmAttrbts/NonRglrTxsQty
    nonregular_traded_contracts integer FinInstrmAttrbts/NonRglrTraddCtrcts
    nonregular_volume numeric FinInstrmAttrbts/NtlNonRglrVol
    oscillation numeric FinInstrmAttrbts/OscnPctg
    adjusted_quote numeric FinInstrmAttrbts/AdjstdQt
    adjusted_tax numeric FinInstrmAttrbts/AdjstdQtTax
    previous_adjusted_quote numeric FinInstrmAttrbts/PrvsAdjstdQt
    previous_adjusted_tax numeric FinInstrmAttrbts/PrvsAdjstdQtTax
    variation_points numeric FinInstrmAttrbts/VartnPts
    adjusted_value_contract numeric FinInstrmAttrbts/AdjstdValCtrct
    days_to_settlement integer FinInstrmAttrbts/DaysToSttlm
    traded_quantity integer TradDtls/TradQty
""")

# fixed values: names and types of delimited, JSON and tabular sources
SETTLEMENT_PRICES = layout("""
    commodity
    maturity_code
    previous_price number
    price number
    price_change number
    settlement_value number
    refdate date(format='%d/%m/%Y')
    symbol
""")
OTC_TRADES = layout("""
    instrument_type
    issuer
    symbol
    traded_quantity numeric
    traded_price numeric(decimal=',')
    volume numeric(decimal=',')
    traded_interest_rate numeric(decimal=',')
    trade_source
    trade_time time(format='%H:%M:%S')
    trade_date date(format='%d/%m/%Y')
    trade_id
    isin
    settlement_date
    trade_status
    refdate date
""")
VOLATILITY_SURFACE = layout("""
    underlying
    type
    maturity_date date(format='%Y%m%d')
    business_days integer
    current_days integer
    delta numeric
    volatility numeric
    refdate date
""")
EQUITY_OPTIONS = layout("""
    symbol
    type
    option_style
    maturity_date date(format='%Y%m%d')
    strike numeric
    theoretic_price numeric
    volatility numeric
    refdate date
""")
CASH_DIVIDENDS = layout("""
    type_stock
    date_approval date(format='%d/%m/%Y')
    value_cash numeric(thousands='.', decimal=',')
    ratio numeric(thousands='.', decimal=',')
    corporate_action
    last_date_prior_ex date(format='%d/%m/%Y')
    date_closing_price_prior_ex_date date(format='%d/%m/%Y')
    closing_price_prior_ex_date numeric(thousands='.', decimal=',')
    quoted_per_shares numeric(thousands='.', decimal=',')
    corporate_action_price numeric(thousands='.', decimal=',')
    last_date_time_prior_ex date(format='%Y-%m-%dT%H:%M:%S')
    refdate date(format='%Y-%m-%d')
    trading_name
""")
COMPANIES_CAPITAL = layout("""
    trading_name
    issuing_company
    company_name
    market
    type_capital
    value numeric(decimal=',')
    approved_date date(format='%d/%m/%Y')
    common_shares numeric(thousands='.')
    preferred_shares numeric(thousands='.')
    total_qty_shares numeric(thousands='.')
    refdate date
""")
COMPANY_DETAILS = layout("""
    issuingCompany
    companyName
    tradingName
    cnpj
    industryClassification
    industryClassificationEng
    activity
    website
    hasQuotation
    status
    marketIndicator
    market
    institutionCommon
    institutionPreferred
    code
    codeCVM
    lastDate
    hasEmissions
    hasBDR
    typeBDR
    describleCategoryBVMF
    isin
    codeCVMarg
    refdate date
""")
LISTED_FUNDS = layout("""
    fund_id
    type
    acronym
    fund_name
    trading_name
    refdate date
""")
CURRENT_PORTFOLIO = layout("""
    segment
    symbol
    corporation_name
    specification_code
    weight number(thousands='.', decimal=',')
    accum_weight number(thousands='.', decimal=',')
    theoretical_quantity number(thousands='.', decimal=',')
    total_weight number(thousands='.', decimal=',')
    total_theoretical_quantity number(thousands='.', decimal=',')
    reductor number(thousands='.', decimal=',')
    portfolio_date date(format='%d/%m/%y')
    index
    refdate date
""")
THEORETICAL_PORTFOLIO = layout("""
    symbol
    corporation_name
    specification_code
    theoretical_quantity number(thousands='.', decimal=',')
    weight number(thousands='.', decimal=',')
    id_asset integer
    total_weight number(thousands='.', decimal=',')
    total_theoretical_quantity number(thousands='.', decimal=',')
    reductor number(thousands='.', decimal=',')
    index
    refdate date
""")
BOND_INDEXES = layout("""
    index_name
    refdate date(format='%Y-%m-%d')
    index_number number
    daily_return_pct number
    month_return_pct number
    year_return_pct number
    return_12m_pct number
    return_24m_pct number
    duration_du number
    pmr number
""")
COMPANY_REGISTRATION = layout("""
    cnpj_cia
    denom_social
    denom_comerc
    dt_reg date(format='%Y-%m-%d')
    dt_const date(format='%Y-%m-%d')
    dt_cancel date(format='%Y-%m-%d')
    motivo_cancel
    sit
    dt_ini_sit date(format='%Y-%m-%d')
    code_cvm integer
    setor_ativ
    tp_merc
    categ_reg
    dt_ini_categ date(format='%Y-%m-%d')
    sit_emissor
    dt_ini_sit_emissor date(format='%Y-%m-%d')
    controle_acionario
    tp_ender
    logradouro
    compl
    bairro
    mun
    uf
    pais
    cep
    ddd_tel
    tel
    ddd_fax
    fax
    email
    tp_resp
    resp
    dt_ini_resp date(format='%Y-%m-%d')
    logradouro_resp
    compl_resp
    bairro_resp
    mun_resp
    uf_resp
    pais_resp
    cep_resp
    ddd_tel_resp
    tel_resp
    ddd_fax_resp
    fax_resp
    email_resp
    cnpj_auditor
    auditor
    refdate date
""")

# fixed values: the daily bulletin, by record type; the first field is the record type itself
BULLETIN_NAMES = {
    "01": "indexes-summary",
    "02": "stocks-summary",
    "03": "trades-summary-bdi",
    "04": "high-oscilations",
    "05": "ibovespa-oscilations",
    "06": "most-traded-stocks",
    "07": "most-traded-assets",
    "08": "iopv-summary",
}
BULLETIN = {
    "01": layout("""
        tipo_registro string 2
        id_indice numeric 2
        nome_indice string 30
        indice_abertura numeric 6
        indice_min numeric 6
        indice_max numeric 6
        indice_med numeric 6
        indice_liquidacao numeric 6
        indice_max_ano numeric 6
        data_indice_max_ano date(format='%Y%m%d') 8
        indice_min_ano numeric 6
        data_indice_min_ano date(format='%Y%m%d') 8
        indice_fechamento numeric 6
        sinal_evolucao_perc_indice_fechamento string 1
        evolucao_perc_indice_fechamento numeric(dec=2) 5
        sinal_evolucao_perc_indice_ontem string 1
        evolucao_perc_indice_ontem numeric(dec=2) 5
        sinal_evolucao_perc_indice_semana string 1
        evolucao_perc_indice_semana numeric(dec=2) 5
        sinal_evolucao_perc_indice_semanal string 1
        evolucao_perc_indice_semanal numeric(dec=2) 5
        sinal_evolucao_perc_indice_mes string 1
        evolucao_perc_indice_mes numeric(dec=2) 5
        sinal_evolucao_perc_indice_mensal string 1
        evolucao_perc_indice_mensal numeric(dec=2) 5
        sinal_evolucao_perc_indice_ano string 1
        evolucao_perc_indice_ano numeric(dec=2) 5
        sinal_evolucao_perc_indice_anual string 1
        evolucao_perc_indice_anual numeric(dec=2) 5
        num_acoes_alta numeric 3
        num_acoes_baixa numeric 3
        num_acoes_estaveis numeric 3
        num_acoes_indice numeric 3
        num_negocios_acoes_indice numeric 6
        qtd_negocios_acoes_indice numeric 15
        volume_negocios_acoes_indice numeric(dec=2) 17
        indice_med_ponderada numeric 6
        reserva string 148
    """),
    "02": layout("""
        tipo_registro string 2
        cod_bdi numeric 2
        descricao_cod_bdi string 30
        nome_empresa string 12
        especificacao string 10
        indicador_caracteristica string 1
        cod_negociacao string 12
        tipo_mercado numeric 3
        descricao_tipo_mercado string 15
        num_dias_mercado_termo numeric 3
        preco_abertura numeric(dec=2) 11
        preco_max numeric(dec=2) 11
        preco_min numeric(dec=2) 11
        preco_med numeric(dec=2) 11
        preco_ult numeric(dec=2) 11
        sinal_oscilacao_preco string 1
        oscilacao_preco numeric(dec=2) 5
        preco_melhor_oferta_compra numeric(dec=2) 11
        preco_melhor_oferta_venda numeric(dec=2) 11
        qtd_negocios numeric 5
        qtd_titulos_negociados numeric 15
        volume_titulos_negociados numeric(dec=2) 17
        preco_exercicio numeric(dec=2) 11
        data_vencimento date(format='%Y%m%d') 8
        indicador_correcao_preco_exercicio numeric 1
        descricao_indicador_correcao_preco_exercicio string 15
        fator_cot numeric 7
        preco_exercicio_pontos numeric(dec=6) 13
        cod_isin string 12
        num_dist numeric 3
        tipo_exercicio numeric 1
        descricao_tipo_exercicio string 15
        indicador_correcao_preco_exercicio_2 numeric 3
        oscilacao_preco_2 numeric(dec=2) 7
        reserva string 44
    """),
    "03": layout("""
        tipo_registro string 2
        cod_bdi numeric 2
        descricao_cod_bdi string 30
        qtd_negocios numeric 5
        qtd_titulos_negociados numeric 15
        volume_titulos_negociados numeric(dec=2) 17
        qtd_negocios_2 numeric 9
        reserva string 270
    """),
    "04": layout("""
        tipo_registro string 2
        sinal_oscilacao string 1
        nome_empresa string 12
        especificacao string 10
        preco_ult numeric(dec=2) 11
        qtd_negocios numeric 5
        oscilacao_preco numeric(dec=2) 5
        cod_negociacao string 12
        oscilacao_preco_2 numeric(dec=2) 7
        reserva string 285
    """),
    "05": layout("""
        tipo_registro string 2
        sinal_oscilacao string 1
        nome_empresa string 12
        especificacao string 10
        preco_ult numeric(dec=2) 11
        qtd_negocios numeric 5
        oscilacao_preco numeric(dec=2) 5
        cod_negociacao string 12
        oscilacao_preco_2 numeric(dec=2) 7
        reserva string 285
    """),
    "06": layout("""
        tipo_registro string 2
        nome_empresa string 12
        especificacao string 10
        qtd_titulos_negociados numeric 15
        volume_titulos_negociados numeric(dec=2) 17
        cod_negociacao string 12
        reserva string 282
    """),
    "07": layout("""
        tipo_registro string 2
        tipo_mercado numeric 3
        descricao_tipo_mercado string 20
        nome_empresa string 12
        especificacao string 10
        indicador_correcao_preco_exercicio numeric 2
        descricao_indicador_correcao_preco_exercicio string 15
        preco_exercicio numeric(dec=2) 11
        data_vencimento date(format='%Y%m%d') 8
        num_dias_mercado_termo numeric 3
        qtd_titulos_negociados numeric 15
        volume_titulos_negociados numeric(dec=2) 17
        participacao_volume_mercado numeric(dec=2) 5
        cod_negociacao string 12
        indicador_correcao_preco numeric 3
        reserva string 212
    """),
    "08": layout("""
        tipo_registro string 2
        id_iopv numeric 2
        sigla_iopv string 4
        nome_resumido_iopv string 12
        nome_iopv string 30
        iopv_abertura numeric(dec=2) 7
        iopv_min numeric(dec=2) 7
        iopv_max numeric(dec=2) 7
        iopv_med numeric(dec=2) 7
        iopv_fechamento numeric(dec=2) 7
        sinal_evolucao_iopv_fechamento string 1
        evolucao_iopv_fechamento numeric(dec=2) 5
        reserva string 259
    """),
}

# fixed values: the tables of a company file; all but the first are arrays in it
COMPANY_INFO_ARRAYS = {"cash_dividends": "cashDividends", "stock_dividends": "stockDividends", "subscriptions": "subscriptions"}
COMPANY_INFO = {
    "info": layout("""
        stockCapital numeric(thousands='.',decimal=',')
        quotedPerSharSince date(format='%d/%m/%Y')
        commonSharesForm string
        preferredSharesForm string
        hasCommom string
        hasPreferred string
        roundLot integer
        tradingName string
        numberCommonShares numeric(thousands='.',decimal=',')
        numberPreferredShares numeric(thousands='.',decimal=',')
        totalNumberShares numeric(thousands='.',decimal=',')
        code string
        codeCVM string
        segment string
    """),
    "cash_dividends": layout("""
        assetIssued string
        paymentDate date(format='%d/%m/%Y')
        rate numeric(thousands='.',decimal=',')
        relatedTo string
        approvedOn date(format='%d/%m/%Y')
        isinCode string
        label string
        lastDatePrior date(format='%d/%m/%Y')
        remarks string
    """),
    "stock_dividends": layout("""
        assetIssued string
        factor numeric(thousands='.',decimal=',')
        approvedOn date(format='%d/%m/%Y')
        isinCode string
        label string
        lastDatePrior date(format='%d/%m/%Y')
        remarks string
    """),
    "subscriptions": layout("""
        assetIssued string
        percentage numeric(thousands='.',decimal=',')
        priceUnit numeric(thousands='.',decimal=',')
        tradingPeriod string
        subscriptionDate date(format='%d/%m/%Y')
        approvedOn date(format='%d/%m/%Y')
        isinCode string
        label string
        lastDatePrior date(format='%d/%m/%Y')
        remarks string
    """),
}
