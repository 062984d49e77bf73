"""Layouts of the exchange's XML messages: what an element is called as a column, and which elements a table has."""

from __future__ import annotations

from collections.abc import Sequence

from tapewright.functions.fields import Field, field_of

# fixed values: element -> column and type (string where none is given), the same in every table
ELEMENTS = {
    "SctyCtgy": "security_category", "ISIN": "isin", "DstrbtnId": "distribution_id integer", "CFICd": "cfi_code",
    "SpcfctnCd": "specification_code", "CrpnNm": "corporation_name", "TckrSymb": "symbol", "PmtTp": "payment_type",
    "AllcnRndLot": "allocation_lot_size integer", "PricFctr": "price_factor numeric", "TradgStartDt": "trading_start_date date",
    "TradgEndDt": "trading_end_date date", "CorpActnStartDt": "corporate_action_start_date date",
    "EXDstrbtnNb": "ex_distribution_number integer", "CtdyTrtmntTp": "custody_treatment_type", "TradgCcy": "trading_currency",
    "MktCptlstn": "market_capitalisation numeric", "LastPric": "close numeric", "FrstPric": "open numeric",
    "GovnInd": "governance_indicator", "DaysToSttlm": "days_to_settlement integer", "RghtsIssePric": "right_issue_price numeric",
    "ExrcPric": "exercise_price numeric", "OptnStyle": "option_style", "ExrcStyle": "exercise_style", "XprtnDt": "maturity_date date",
    "OptnTp": "option_type", "PrtcnFlg": "protection_flag", "PrmUpfrntInd": "premium_upfront_indicator", "DlvryTp": "delivery_type",
    "AutomtcExrcInd": "automatic_exercise_indicator", "XprtnCd": "expiration_code", "ValTpCd": "value_type_code",
    "CtrctMltplr": "contract_multiplier numeric", "AsstQtnQty": "asset_quotation_quantity numeric", "WdrwlDays": "withdrawal_days integer",
    "WrkgDays": "working_days integer", "ClnrDays": "calendar_days integer", "OpngPosLmtDt": "opening_position_limit_date date",
    "OptnDlvryTp": "option_delivery_type", "SttlmIndMltplr": "settlement_multiplier numeric", "CUSIP": "cusip",
    "IssrCtry": "issuer_country", "Tp": "bond_type", "IssePric": "issue_price numeric", "IsseDt": "issue_date date",
    "MtrtyDt": "maturity_date date", "Ccy": "currency", "SelicCd": "selic_code", "BaseDt": "base_date date",
    "MtrtyVal": "maturity_value numeric", "BaseDtPric": "base_date_price numeric", "BrzlnFdrlGovntBdTpCd": "bond_type_code",
    "SctyLndgGovntBdInd": "security_lending_indicator", "GovntBdRepoSpcfcInd": "repo_specific_indicator",
    "GovntBdRepoGnlInd": "repo_general_indicator", "AsstRegnDt": "asset_registration_date date", "IsseCd": "issue_code",
    "SrsNb": "series_number", "AsstCollTp": "asset_collateral_type", "AsstAddtlCollTp": "asset_additional_collateral_type",
    "AsstSubrdntdTp": "asset_subordinated_type", "DbnrConvtbltTp": "debenture_convertibility_type",
    "DbnrTaxBnft/Artl1Ind": "debenture_tax_benefit_article1", "DbnrTaxBnft/Artl2Ind": "debenture_tax_benefit_article2",
    "PerptlDbnrInd": "perpetual_debenture_indicator", "IntrstRate": "interest_rate numeric",
    "IntrstRateCrrctnTp": "interest_rate_correction_type", "IntrstRateCrrctnTmBase": "interest_rate_correction_time_base",
    "IndxPctg": "index_percentage numeric", "EarlyRedInd": "early_redemption_indicator",
    "TtlSrsIsseVal": "total_series_issue_value numeric", "UnitVal": "unit_value numeric", "RskRtg": "risk_rating",
    "PrgmLvl": "program_level", "Ppsn": "proportion", "FngbInd": "fungibility_indicator", "CtrctTp": "contract_type",
    "TradOrgnCd": "trade_origin_code", "CcyCd": "currency_code", "FndNm": "fund_name",
    "AsstDesc": "asset_desc", "SttlmVal": "settlement_price numeric", "OpngPric": "open_price numeric", "MinPric": "min_price numeric",
    "MaxPric": "max_price numeric", "TradAvrgPric": "average_price numeric", "ClsgPric": "close_price numeric",
    "IndxVal": "last_price numeric", "OscnVal": "oscillation_val numeric", "RefPric": "ref_price numeric",
    "RsngShrsNb": "rising_shares_number integer", "FlngShrsNb": "falling_shares_number integer",
    "StblShrsNb": "stable_shares_number integer",
}

# fixed values: an element that names an instrument -> the start of the columns of its id, its kind and its market
REFERENCES = {
    "UndrlygInstrmId": "underlying_security",
    "OptnExrcInstrmId": "option_exercise_security",
    "DerivOptnExrcInstrmId": "derivative_exercise_security",
    "AsstSttlmInd": "asset_settlement_security",
    "AsstInd": "asset_indicator_security",
}

# fixed values: what all instruments have before their own element
COMMON = (
    "refdate date RptParams/RptDtAndTm/Dt",
    "security_id string FinInstrmId/OthrId/Id",
    "security_proprietary string FinInstrmId/OthrId/Tp/Prtry",
    "security_market string FinInstrmId/PlcOfListg/MktIdrCd",
    "instrument_asset string FinInstrmAttrCmon/Asst",
    "instrument_asset_description string FinInstrmAttrCmon/AsstDesc",
    "instrument_market string FinInstrmAttrCmon/Mkt",
    "instrument_segment string FinInstrmAttrCmon/Sgmt",
    "instrument_description string FinInstrmAttrCmon/Desc",
)

# fixed values: table -> its element and the elements in it; "x=y" calls the column of element x y
INSTRUMENTS = {
    "equities": ("EqtyInf", "SctyCtgy ISIN DstrbtnId CFICd SpcfctnCd CrpnNm TckrSymb PmtTp AllcnRndLot PricFctr TradgStartDt TradgEndDt "
        "CorpActnStartDt EXDstrbtnNb CtdyTrtmntTp TradgCcy MktCptlstn LastPric FrstPric GovnInd DaysToSttlm RghtsIssePric"),
    "options_on_equities": ("OptnOnEqtsInf", "SctyCtgy ISIN TckrSymb ExrcPric OptnStyle XprtnDt OptnTp UndrlygInstrmId PrtcnFlg PrmUpfrntInd "
        "TradgStartDt TradgEndDt PmtTp AllcnRndLot PricFctr TradgCcy DaysToSttlm DlvryTp AutomtcExrcInd"),
    "future_contracts": ("FutrCtrctsInf", "SctyCtgy XprtnDt TckrSymb XprtnCd TradgStartDt TradgEndDt ValTpCd ISIN CFICd DlvryTp PmtTp CtrctMltplr "
        "AsstQtnQty=asset_settlement_indicator AllcnRndLot TradgCcy UndrlygInstrmId WdrwlDays WrkgDays ClnrDays"),
    "exercise_of_equities": ("ExrcEqtsInf", "SctyCtgy TckrSymb ISIN TradgCcy TradgStartDt TradgEndDt DlvryTp OptnExrcInstrmId"),
    "fixed_income": ("FxdIncmInf", "SctyCtgy ISIN TckrSymb TradgStartDt TradgEndDt TradgCcy PmtTp DaysToSttlm AllcnRndLot PricFctr UndrlygInstrmId"),
    "options_on_spot_and_futures": ("OptnOnSpotAndFutrsInf", "ISIN TckrSymb ExrcPric ExrcStyle XprtnDt XprtnCd OptnTp CtrctMltplr AsstQtnQty PmtTp "
        "AllcnRndLot CFICd UndrlygInstrmId PrmUpfrntInd TradgStartDt TradgEndDt OpngPosLmtDt TradgCcy AsstSttlmInd WdrwlDays WrkgDays ClnrDays"),
    "derivatives_option_exercise": ("DrvsOptnExrcInf", "SctyCtgy TckrSymb ISIN OptnDlvryTp SttlmIndMltplr DerivOptnExrcInstrmId AsstSttlmInd "
        "WdrwlDays WrkgDays ClnrDays"),
    "equity_forwards": ("EqtyFwdInf", "SctyCtgy TckrSymb ISIN DstrbtnId CFICd PmtTp AllcnRndLot PricFctr TradgStartDt TradgEndDt CtdyTrtmntTp "
        "TradgCcy UndrlygInstrmId"),
    "international_bonds": ("IntlBdInf", "SctyCtgy ISIN CUSIP IssrCtry Tp IssePric IsseDt MtrtyDt Ccy"),
    "national_bonds": ("NtlBdInf", "SctyCtgy ISIN SelicCd BaseDt MtrtyVal BaseDtPric IsseDt MtrtyDt BrzlnFdrlGovntBdTpCd SctyLndgGovntBdInd "
        "GovntBdRepoSpcfcInd GovntBdRepoGnlInd"),
    "fixed_income_non_tradable": ("FxdIncmNonTrdblInf", "SctyCtgy ISIN DstrbtnId EXDstrbtnNb CtdyTrtmntTp CFICd SpcfctnCd CrpnNm AsstRegnDt IsseCd SrsNb "
        "AsstCollTp AsstAddtlCollTp AsstSubrdntdTp DbnrConvtbltTp DbnrTaxBnft/Artl1Ind DbnrTaxBnft/Artl2Ind PerptlDbnrInd IsseDt BaseDt "
        "IntrstRate IntrstRateCrrctnTp IntrstRateCrrctnTmBase IndxPctg EarlyRedInd TtlSrsIsseVal UnitVal MktCptlstn XprtnDt TradgStartDt "
        "TradgEndDt TckrSymb RskRtg TradgCcy FrstPric LastPric AsstInd"),
    "adrs": ("ADRInf", "SctyCtgy TckrSymb ISIN CFICd CUSIP PrgmLvl Ppsn TradgCcy"),
    "securities_lending": ("BTCInf", "SctyCtgy TckrSymb FngbInd PmtTp"),
    "otc_derivatives": ("OTCInf", "CtrctTp TradOrgnCd FngbInd"),
    "cash": ("CshInf", "SctyCtgy CFICd CcyCd"),
    "investment_funds": ("FICInf", "SctyCtgy FndNm Ccy"),
}

# fixed values: tables in which the underlying instrument's market is below its other id
MARKET_BELOW_ID = ("options_on_equities", "future_contracts")

# fixed values: table -> its element, where the instrument is named, and the further elements
INDEXES = {
    "indexes_info": ("IndxInf", "SctyInf/SctyId/TckrSymb", "SctyInf/FinInstrmId",
        "AsstDesc SttlmVal SctyInf/OpngPric SctyInf/MinPric SctyInf/MaxPric SctyInf/TradAvrgPric SctyInf/ClsgPric SctyInf/IndxVal SctyInf/OscnVal "
        "RsngShrsNb FlngShrsNb StblShrsNb"),
    "iopv_info": ("IOPVInf", "SctyId/TckrSymb", "FinInstrmId", "OpngPric MinPric MaxPric TradAvrgPric ClsgPric IndxVal OscnVal"),
    "bdr_info": ("BDRInf", "SctyId/TckrSymb", "FinInstrmId", "RefPric"),
}


def _reference(start: str, path: str, market: str = "PlcOfListg", kind: str = "string") -> list[Field]:
    """An instrument's id, the kind of the id and its market."""
    return [
        field_of(f"{start}_id", kind, tag=f"{path}/OthrId/Id"),
        field_of(f"{start}_proprietary", kind, tag=f"{path}/OthrId/Tp/Prtry"),
        Field(f"{start}_market", tag=f"{path}/{market}/MktIdrCd"),
    ]


def _element(path: str, below: str = "") -> Field:
    path, _, name = path.partition("=")
    known, _, kind = ELEMENTS.get(path, ELEMENTS.get(path.rpartition("/")[2], "")).partition(" ")
    return field_of(name or known, kind or "string", tag=f"{below}{path}")


def _table(table: str, element: str, elements: Sequence[str]) -> list[Field]:
    fields = []
    for line in COMMON:
        name, kind, path = line.split()
        fields.append(field_of(name, kind, tag=path))
    below = f"InstrmInf/{element}/"
    for e in elements:
        if e in REFERENCES:
            fields += _reference(REFERENCES[e], below + e, "OthrId/PlcOfListg" if table in MARKET_BELOW_ID else "PlcOfListg")
        else:
            fields.append(_element(e, below))
    return fields


# table -> element; element -> fields, as the readers take them
INSTRUMENT_NAMES = {element: table for table, (element, _) in INSTRUMENTS.items()}
INSTRUMENT_FIELDS = {element: _table(table, element, elements.split()) for table, (element, elements) in INSTRUMENTS.items()}
INDEX_NAMES = {element: table for table, (element, *_) in INDEXES.items()}
INDEX_FIELDS = {
    element: [Field("symbol", tag=symbol), *_reference("security", named, kind="integer"), *map(_element, elements.split())]
    for element, symbol, named, elements in INDEXES.values()
}
