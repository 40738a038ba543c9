"""The truck-loads endpoint."""

from __future__ import annotations

from landfall.plans.spec import LoadSpec

# The endpoint's tags and names, its record fields in order, and the bronze columns.
ROW_TAG = "ns1:listaCargasResponse"
PAYLOAD = "resParam"
ENTITY = "listaCargas"

FIELDS = tuple(
    """
    t10_id t10_data_grava t10_sn_planejada t10_destino t10_data_saida t10_data_prevista_termino
    t06_id t06_descricao t06_placa t06_peso_max_entregas t06_volume_max_entregas t06_qtdMaxEntregas
    t06_modelo t06_dataHoraAtual t06_latitudeAtual t06_longitudeAtual
    t05_id t05_codigo_erp t05_nome t43_fantasia
    t10_motorista_id
    t10_ajudante1_id t05_codigo_erp_ajudante1 t05_nome_ajudante1
    t10_ajudante2_id t05_codigo_erp_ajudante2 t05_nome_ajudante2
    t10_ajudante3_id t05_codigo_erp_ajudante3 t05_nome_ajudante3
    t10_ajudante4_id t05_codigo_erp_ajudante4 t05_nome_ajudante4
    t10_transporte_id t10_situacao t10_carga_formada_erp t10_sn_deve_formar_carga_erp
    t10_status_integracao t10_retorno_internalizacao t10_senha_mobile_cast
    t10_custo_estimado t10_diarias_completas t10_diarias_simples t10_kmTotal t10_qtd_almoco
    t10_qtd_cafe_manha t10_qtd_hospedagens t10_qtd_jantar t10_qtd_pallets_carga
    t10_sn_frete_negociado t10_sn_utiliza_chapa t10_tempoTotal t10_tipo_chapa
    t10_valor_adiantado_motorista t10_valor_adiantamento_extra t10_valor_chapa t10_valor_descarrego
    t10_valor_frete_negociado
    peso_entregas qtd_pallets_entregas valor_entregas volume_entregas qtd_clientes clientes
    qtd_entregas t141_id t141_descricao data_atualizacao responsavel_atualizacao
    """.split()
)

KEEP = ("t10_id", "t10_data_grava", "t10_destino", "t06_placa", "t10_situacao", "t06_id")


def loads_spec(landing: str, target: str, source_name: str, **changes) -> LoadSpec:
    """The endpoint's spec. Only the bronze columns are parsed; pass ``keep=FIELDS`` for all of them."""
    spec = LoadSpec(landing, ROW_TAG, PAYLOAD, FIELDS, ENTITY, source_name, target, keep=KEEP)
    return spec.but(**changes)
