WITH live AS (
  SELECT * EXCLUDE (posicao), MAP {'P': 'aguardado liberação', 'B': 'pedido bloqueado', 'L': 'pedido liberado', 'F': 'pedido faturado',
           'C': 'pedido cancelado', 'R': 'pedido em separacao', 'D': 'pedido duplicado', 'M': 'pedido em montagem'}[posicao] AS state,
         COALESCE(MAP {'T': 'TELEMARKETING', 'W': 'E-COMMERCE'}[origemped], CASE origemped WHEN 'F' THEN
           COALESCE(MAP {'PE': 'PEDIDO ELETRÔNICO', 'OL': 'OPERADOR LOGÍSTICO'}[tipofv], 'FORÇA DE VENDAS') END, 'OUTROS') AS channel
  FROM pcpedc WHERE dtcancel IS NULL AND data >= DATE '2001-01-01')
SELECT item.codprod AS cod_produto, item.numlote AS num_lote, item.qt::DOUBLE AS quantidade, item.qtfalta::DOUBLE AS qtd_falta,
       item.pvenda::DOUBLE AS vl_venda_unitario, numped AS numero_pedido, live.numtransvenda, live.data AS data_pedido,
       live.codcli AS cod_cliente, live.codusur AS cod_vendedor, live.codemitente AS cod_emitente, live.codfilial AS cod_filial,
       live.vltotal::DOUBLE AS valor_total, live.vlatend::DOUBLE AS valor_atendido, live.channel AS origem_pedido,
       COALESCE(live.state, 'outros') AS posicao_pedido
FROM pcpedi AS item JOIN live USING (numped)
