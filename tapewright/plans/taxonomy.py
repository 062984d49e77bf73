"""Names of the exchange's sectors in other taxonomies."""

from __future__ import annotations

# fixed values: sector -> (first taxonomy, second taxonomy, plain name); any other sector is Unclassified in all three
SECTORS = {
    "Financeiro": ("Financials", "Financials", "Financials"),
    "Bens Industriais": ("Industrials", "Industrials", "Industrials"),
    "Materiais Básicos": ("Materials", "Basic Materials", "Materials"),
    "Consumo Cíclico": ("Consumer Discretionary", "Consumer Goods", "Consumer Discretionary"),
    "Consumo não Cíclico": ("Consumer Staples", "Consumer Services", "Consumer Staples"),
    "Utilidade Pública": ("Utilities", "Utilities", "Utilities"),
    "Petróleo. Gás e Biocombustíveis": ("Energy", "Oil & Gas", "Energy"),
    "Saúde": ("Health Care", "Health Care", "Health Care"),
    "Tecnologia da Informação": ("Information Technology", "Technology", "Information Technology"),
    "Comunicações": ("Communication Services", "Telecommunications", "Communication Services"),
    "Imobiliário": ("Real Estate", "Real Estate", "Real Estate"),
    "Construção e Transporte": ("Industrials", "Industrials", "Construction & Transportation"),
    "Outros": ("Other", "Other", "Other"),
}
UNCLASSIFIED = "Unclassified"

# fixed values: sector -> subsector -> plain name; any other pair is Other
SUBSECTORS = {
    "Financeiro": {
        "Intermediários Financeiros": "Banking",
        "Previdência e Seguros": "Insurance & Pension Funds",
        "Exploração de Imóveis": "Real Estate",
        "Securitizadoras de Recebíveis": "Asset Management & Investment",
        "Serviços Financeiros Diversos": "Financial Services",
        "Holdings Diversificadas": "Holding Companies",
        "Serviços Diversos": "Financial Services",
    },
    "Bens Industriais": {
        "Material de Transporte": "Transportation Equipment",
        "Máquinas e Equipamentos": "Machinery & Equipment",
        "Transporte": "Transportation Services",
        "Construção e Engenharia": "Construction",
        "Serviços": "Industrial Services",
        "Comércio": "Trade & Distribution",
        "Tecnologia da Informação": "Technology",
    },
    "Materiais Básicos": {
        "Siderurgia e Metalurgia": "Steel & Metals",
        "Mineração": "Mining",
        "Químicos": "Chemicals",
        "Madeira e Papel": "Timber & Pulp",
        "Embalagens": "Packaging",
        "Materiais Diversos": "Other Materials",
    },
    "Consumo Cíclico": {
        "Automóveis e Motocicletas": "Automobiles",
        "Comércio": "Retail",
        "Construção Civil": "Real Estate Development",
        "Hoteis e Restaurantes": "Hotels & Restaurants",
        "Tecidos. Vestuário e Calçados": "Apparel & Footwear",
        "Utilidades Domésticas": "Home Appliances & Furnishings",
        "Viagens e Lazer": "Leisure & Travel",
        "Diversos": "Diversified Consumer",
    },
    "Consumo não Cíclico": {
        "Agropecuária": "Agriculture",
        "Alimentos Processados": "Food & Beverage",
        "Bebidas": "Beverages",
        "Comércio e Distribuição": "Retail & Distribution",
        "Produtos de Uso Pessoal e de Limpeza": "Personal Care & Hygiene",
        "Diversos": "Diversified Consumer",
    },
    "Utilidade Pública": {
        "Energia Elétrica": "Electric Utilities",
        "Gás": "Gas Utilities",
        "Água e Saneamento": "Water & Sewer",
    },
    "Petróleo. Gás e Biocombustíveis": {
        "Petróleo. Gás e Biocombustíveis": "Oil, Gas & Biofuels",
        "Equipamentos e Serviços": "Oil & Gas Equipment & Services",
        "Exploração. Refino e Distribuição": "Oil & Gas Exploration & Production",
        "Distribuição de Combustíveis": "Fuel Distribution",
    },
    "Saúde": {
        "Medicamentos e Outros Produtos": "Pharmaceuticals",
        "Comércio e Distribuição": "Pharmaceutical Distribution",
        "Equipamentos": "Medical Equipment",
        "Serv.Méd.Hospit..Análises e Diagnósticos": "Healthcare Services",
    },
    "Tecnologia da Informação": {
        "Computadores e Equipamentos": "Computer Hardware",
        "Programas e Serviços": "Software & IT Services",
    },
    "Comunicações": {
        "Telecomunicações": "Telecommunications",
        "Mídia": "Media & Entertainment",
    },
    "Construção e Transporte": {
        "Transporte": "Transportation Services",
        "Construção e Engenharia": "Construction",
    },
}
UNNAMED = "Other"
